"""H and M: column functions over the retail tables."""

from pyspark.sql import functions as F

from tradewind.checks.registry import query
from tradewind.functions import columns as X
from tradewind.functions import udfs
from tradewind.functions.domains import STATES_BY_REGION, state_regions

SENTIMENT_SQL = """
    case when review_score >= 4 then 'positive' when review_score = 3 then 'neutral'
         else 'negative' end"""


@query("h1_casts", """
    select order_id, order_item_id, shipping_limit_ts, cast(shipping_limit_ts as date)
               as limit_day, cast(price as double) as price, cast(order_id as varchar) as text
    from s_order_items""")
def _(t):
    c = F.col
    return t.landed_order_items.select(
        c("order_id").cast("bigint").alias("order_id"),
        c("order_item_id").cast("int").alias("order_item_id"),
        c("shipping_limit_date").cast("timestamp_ntz").alias("shipping_limit_ts"),
        c("shipping_limit_date").cast("date").alias("limit_day"),
        c("price").cast("double").alias("price"), c("order_id").alias("text"))


@query("h2_decimal_casts", """
    select seller_id, cast(sum(cast(price as decimal(10,2)) - cast(freight_value
               as decimal(10,2))) as double) as net from s_order_items group by seller_id""")
def _(t):
    net = X.money("price") - X.money("freight_value")
    return t.landed_order_items.groupBy(F.col("seller_id").cast("bigint").alias("seller_id")).agg(
        F.sum(net).cast("double").alias("net"))


@query("h3_try_casts", """
    select order_id, try_cast(case when order_id % 7 = 0 then 'unknown'
               else cast(order_purchase_ts as varchar) end as timestamp) as bought
    from s_orders""")
def _(t):
    text = F.when(F.col("order_id") % 7 == 0, "unknown").otherwise(
        F.col("order_purchase_ts").cast("string"))
    return t.orders_placed.select("order_id", X.typed(text, "timestamp_ntz").alias("bought"))


@query("h4_boolean_to_int", """
    select order_id, cast(order_status = 'delivered' as int) as delivered from s_orders""")
def _(t):
    return t.orders_placed.select(
        "order_id", (F.col("order_status") == "delivered").cast("int").alias("delivered"))


@query("h5_calendar_days", """
    select review_id, cast(date_diff('day', review_answer_timestamp,
               review_answer_timestamp + interval 36 hour) as int) as days
    from s_order_reviews""")
def _(t):
    ts = F.col("review_answer_timestamp")
    return t.order_reviews.select(
        "review_id", X.calendar_days(ts, ts + F.expr("interval 36 hours")).alias("days"))


@query("h6_elapsed_days", """
    select review_id, date_sub('day', review_answer_timestamp,
               review_answer_timestamp + interval 36 hour) as days from s_order_reviews""")
def _(t):
    ts = F.col("review_answer_timestamp")
    return t.order_reviews.select(
        "review_id", X.elapsed_days(ts, ts + F.expr("interval 36 hours")).alias("days"))


@query("h7_parsed_whole_days", """
    select order_id, cast(floor(date_diff('second', order_purchase_ts, delivered_at)
               / 86400) as int) as days,
           cast(floor(date_diff('second', delivered_at, order_purchase_ts) / 86400) as int)
               as back
    from s_orders""")
def _(t):
    bought, came = "order_purchase_timestamp", "order_delivered_customer_date"
    return t.landed_orders.select(
        F.col("order_id").cast("bigint").alias("order_id"),
        X.whole_days_between_texts(bought, came).alias("days"),
        X.whole_days_between_texts(came, bought).alias("back"))


@query("h8_month_start", """
    select event_id, cast(date_trunc('month', ts) as date) as month from events""")
def _(t):
    return t.raw("events").select("event_id", X.month_start("ts").alias("month"))


@query("h9_month_text", "select event_id, strftime(ts, '%Y-%m') as month from events")
def _(t):
    return t.raw("events").select("event_id", X.month_text("ts").alias("month"))


@query("h10_now", """
    select count(*) filter (where order_purchase_ts <= current_timestamp) as past from s_orders""")
def _(t):
    return t.orders_placed.agg(
        F.count_if(F.col("order_purchase_ts") <= F.current_timestamp()).alias("past"))


@query("h11_place_names", """
    select customer_id, upper(customer_city) as city, upper(customer_state) as state
    from s_customers""")
def _(t):
    return t.landed_customers.select(
        F.col("customer_id").cast("bigint").alias("customer_id"),
        X.place_name("customer_city").alias("city"),
        X.place_name("customer_state").alias("state"))


@query("h12_text_flags", """
    select doc_id, length(trim(text, ' ')) as n, length(trim(text, ' ')) > 0 as has_text
    from documents""")
def _(t):
    return t.raw("documents").select("doc_id", F.length(F.trim("text")).cast("bigint").alias("n"),
                                     X.has_text("text").alias("has_text"))


@query("h13_surrogate_key", """
    select md5(cast(product_id as varchar) || '-' ||
               coalesce(product_category_name, '_dbt_utils_surrogate_key_null_')) as sk,
           product_id from s_products""")
def _(t):
    return t.products.select(
        X.surrogate_key("product_id", "product_category_name").alias("sk"), "product_id")


@query("h14_rounding_arithmetic", """
    select order_id, order_item_id, cast(round(price * 0.125, 2) as double) as eighth,
           cast(price - freight_value as double) as net, cast(-price as double) as minus
    from s_order_items""")
def _(t):
    price = F.col("price")
    return t.order_items.select(
        "order_id", "order_item_id",
        F.round(price * F.lit("0.125").cast("decimal(4,3)"), 2).cast("double").alias("eighth"),
        (price - F.col("freight_value")).cast("double").alias("net"),
        (-price).cast("double").alias("minus"))


@query("h15_nullif", """
    select order_id, order_item_id, cast(nullif(freight_value, 0) as double) as freight
    from s_order_items""")
def _(t):
    return t.order_items.select("order_id", "order_item_id", F.nullif(
        F.col("freight_value").cast("double"), F.lit(0.0)).alias("freight"))


@query("h16_random_bucket", """
    select count(*) as n, 0::bigint as outside, 8::bigint as buckets from s_order_items""")
def _(t):
    bucket = F.col("bucket")
    return t.order_items.select(X.random_bucket(8, seed=7).alias("bucket")).agg(
        X.rows().alias("n"), F.count_if((bucket < 0) | (bucket > 7)).alias("outside"),
        F.countDistinct(bucket).alias("buckets"))


@query("h17_on_time_flag", """
    select order_id, delivered_at <= estimated_delivery_at as is_on_time from s_orders""")
def _(t):
    return t.orders.select("order_id", X.on_time("delivered_at", "estimated_delivery_at")
                           .alias("is_on_time"))


@query("h18_late_flag", """
    select order_id, case when delivered_at > estimated_delivery_at then 1 else 0 end as is_late
    from s_orders""")
def _(t):
    return t.orders.select("order_id", X.late_flag("delivered_at", "estimated_delivery_at")
                           .alias("is_late"))


@query("h19_sentiment", f"""
    with r as (select review_id, order_id, case when order_id % 11 <> 0 then review_score end
                      as review_score from s_order_reviews)
    select review_id, order_id, {SENTIMENT_SQL} as sentiment from r""")
def _(t):
    score = X.typed("review_score", "int")
    return t.landed_order_reviews.select(
        F.col("review_id").cast("bigint").alias("review_id"),
        F.col("order_id").cast("bigint").alias("order_id"), X.sentiment(score).alias("sentiment"))


@query("h20_lookup_with_default", """
    select order_id, case order_status when 'delivered' then 'closed' when 'shipped'
               then 'moving' else 'other' end as phase from s_orders""")
def _(t):
    phases = {"delivered": "closed", "shipped": "moving"}
    return t.orders_placed.select("order_id", X.lookup("order_status", phases, "other")
                                  .alias("phase"))


@query("h20_seed_lookup", f"""
    select customer_id, coalesce(case customer_state {' '.join(
        f"when '{s}' then '{r}'" for r, group in STATES_BY_REGION.items() for s in group)} end,
        'abroad') as region from s_customers""")
def _(t):
    """The state seed has 27 rows; the shaped states are all outside it."""
    seed = F.broadcast(state_regions(t.spark))
    located = t.customers.join(seed, t.customers["customer_state"] == seed["state"], "left")
    return located.select("customer_id", X.first_known("region", default="abroad").alias("region"))


@query("h21_array_functions", """
    with v as (select vec_id, [x::double for x in embedding] as a from embeddings)
    select vec_id, len(a) as n, round(list_sum(a), 4) as total, list_max(a) as high,
           list_min(a) as low, len([x for x in a if x > 0.1]) as above,
           round(coalesce(list_sum([x for x in a if x > 0.1]), 0), 4) as above_total,
           list_reverse_sort(a)[1] as first, list_reverse_sort(a)[-1] as last
    from v""")
def _(t):
    values = F.col("embedding").cast("array<double>")
    ordered = X.array_descending(values)
    above = X.array_above(values, 0.1)
    return t.raw("embeddings").select(
        "vec_id", F.size(values).cast("bigint").alias("n"),
        F.round(X.array_total(values), 4).alias("total"),
        F.array_max(values).alias("high"), F.array_min(values).alias("low"),
        F.size(above).cast("bigint").alias("above"),
        F.round(X.array_total(above), 4).alias("above_total"),
        F.element_at(ordered, 1).alias("first"), F.element_at(ordered, -1).alias("last"))


def status_counts(t):
    """Per customer, a map from each of the three statuses to its count."""
    statuses = ("canceled", "delivered", "shipped")
    counts = t.orders_placed.groupBy("customer_id").agg(
        *[F.count_if(F.col("order_status") == s).alias(s) for s in statuses])
    pairs = [part for s in statuses for part in (F.lit(s), F.col(s))]
    return counts.select("customer_id", F.create_map(*pairs).alias("counts"))


@query("h22_map_top_entries", """
    with c as (select customer_id, order_status as status, count(*) as n
               from s_orders group by all)
    select customer_id, arg_max(status, n * 1000 - ascii(status)) as busiest, max(n) as busiest_n
    from c group by customer_id""")
def _(t):
    top = X.map_top("counts", 1)[0]
    return status_counts(t).select("customer_id", top["key"].alias("busiest"),
                                   top["value"].alias("busiest_n"))


@query("h23_map_filter", """
    with c as (select customer_id, order_status as status, count(*) as n
               from s_orders group by all)
    select customer_id, count(*) filter (where n > 3) as frequent,
           coalesce(string_agg(status, ',' order by status) filter (where n > 3), '') as names
    from c group by customer_id""")
def _(t):
    kept = X.map_above("counts", 3)
    return status_counts(t).select(
        "customer_id", F.size(kept).cast("bigint").alias("frequent"),
        F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("names"))


@query("h24_sentiment_histogram", f"""
    select {SENTIMENT_SQL} as sentiment, count(*) as n from s_order_reviews group by 1""")
def _(t):
    return t.order_reviews.groupBy(X.sentiment("review_score").alias("sentiment")).agg(
        X.rows().alias("n"))


@query("m1_sentiment_udf", f"""
    select {SENTIMENT_SQL} as sentiment, count(*) as n from s_order_reviews group by 1""")
def _(t):
    return t.order_reviews.groupBy(udfs.sentiment_by_batch("review_score").alias("sentiment")).agg(
        X.rows().alias("n"))


@query("m2_udf_equals_builtin", """
    select count(*) as n, 0::bigint as different from s_order_reviews""")
def _(t):
    both = t.order_reviews.select(X.sentiment("review_score").alias("a"),
                                  udfs.sentiment_by_row("review_score").alias("b"))
    return both.agg(X.rows().alias("n"), F.count_if(F.col("a") != F.col("b")).alias("different"))


@query("m3_label_macro", """
    select product_id, coalesce(product_category_name_english, product_category_name, 'unknown')
               as label
    from s_products left join s_translation using (product_category_name)""")
def _(t):
    named = t.products.join(t.translation, "product_category_name", "left")
    return named.select("product_id", X.first_known(
        "product_category_name_english", "product_category_name", default="unknown")
        .alias("label"))
