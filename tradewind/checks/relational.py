"""B-G: projections, filters, joins, aggregates, windows, sorts over the retail tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradewind.checks.registry import query
from tradewind.functions import columns as X
from tradewind.functions.domains import STATES_BY_REGION, state_regions
from tradewind.operators import aggregates, joins, ranking
from tradewind.plans import explore, star
from tradewind.sources import tables

NTZ = "timestamp_ntz"


def day(text):
    return F.lit(text).cast(NTZ)


# --- B projections, filters, predicates --------------------------------------

@query("b1_projection", """
    select order_id as id, order_status as status, customer_id from s_orders""")
def _(t):
    return t.orders_placed.select(F.col("order_id").alias("id"),
                                  F.col("order_status").alias("status"), "customer_id")


@query("b2_derived_column", """
    select order_id, order_item_id, cast(price + freight_value as double) as item_total
    from s_order_items""")
def _(t):
    return t.order_items.select("order_id", "order_item_id", (
        F.col("price") + F.col("freight_value")).cast("double").alias("item_total"))


@query("b3_equality_filter", """
    select order_id, order_purchase_ts from s_orders where order_status = 'shipped'""")
def _(t):
    return t.orders_placed.filter(F.col("order_status") == "shipped").select(
        "order_id", "order_purchase_ts")


@query("b4_range_filter", """
    select order_id, cast(price as double) as price from s_order_items where price > 50000""")
def _(t):
    return t.order_items.filter(F.col("price") > 50000).select(
        "order_id", F.col("price").cast("double").alias("price"))


@query("b5_null_filters", """
    select case when delivered_at is null then 'open' else 'arrived' end as state,
           count(*) as n from s_orders group by 1""")
def _(t):
    state = F.when(F.col("delivered_at").isNull(), "open").otherwise("arrived")
    return t.orders.groupBy(state.alias("state")).agg(X.rows().alias("n"))


@query("b6_in_list", """
    select order_id, order_status from s_orders where order_status in ('shipped', 'canceled')""")
def _(t):
    return t.orders_placed.filter(F.col("order_status").isin("shipped", "canceled")).select(
        "order_id", "order_status")


@query("b7_between", """
    select review_id, order_id, review_score from s_order_reviews
    where review_score between 2 and 4""")
def _(t):
    return t.order_reviews.filter(F.col("review_score").between(2, 4)).select(
        "review_id", "order_id", "review_score")


@query("b8_null_guard", """
    select product_id from s_products
    where product_category_name is null or (product_weight_g > 10
          and product_category_name <> 'PROMO')""")
def _(t):
    category = F.col("product_category_name")
    return t.products.filter(category.isNull() | (
        (F.col("product_weight_g") > 10) & (category != "PROMO"))).select("product_id")


@query("b9_regex_before_cast", """
    select order_id, review_score from s_order_reviews where order_id % 11 <> 0""")
def _(t):
    readable = t.landed_order_reviews.filter(F.col("review_score").rlike("^[1-5]$"))
    return readable.select(F.col("order_id").cast("bigint").alias("order_id"),
                           X.typed("review_score", "int").alias("review_score"))


@query("b10_case", """
    select order_id, case when delivered_at is not null
               then cast(date_diff('day', order_purchase_ts, delivered_at) as int) end as days,
           case when delivered_at is null then 'open'
                when delivered_at > estimated_delivery_at then 'late' else 'on time' end as state
    from s_orders""")
def _(t):
    arrived = F.col("delivered_at").isNotNull()
    days = F.when(arrived, X.calendar_days("order_purchase_ts", "delivered_at"))
    state = (F.when(~arrived, "open")
             .when(~X.on_time("delivered_at", "estimated_delivery_at"), "late")
             .otherwise("on time"))
    return t.orders.select("order_id", days.alias("days"), state.alias("state"))


@query("b11_coalesce", """
    select product_id, coalesce(product_category_name, 'unknown') as category from s_products""")
def _(t):
    return t.products.select("product_id", F.col("product_category_name").alias("category")).fillna(
        {"category": "unknown"})


@query("b12_distinct", "select distinct order_id, product_id from s_order_items")
def _(t):
    return t.order_items.select("order_id", "product_id").distinct()


@query("b13_drop_helper", """
    select order_id, order_item_id, product_id, seller_id, cast(price as double) as price
    from s_order_items""")
def _(t):
    helper = t.order_items.withColumn("half", F.col("price") / 2)
    return helper.withColumn("price", F.col("price").cast("double")).drop(
        "half", "shipping_limit_ts", "freight_value")


@query("b14_chained_ctes", """
    with spent as (select customer_id, count(*) as n from s_orders group by customer_id),
         busy as (select customer_id, n from spent where n >= 12),
         placed as (select customer_state, n from busy join s_customers using (customer_id))
    select customer_state, count(*) as customers, cast(sum(n) as bigint) as orders
    from placed group by customer_state""")
def _(t):
    spent = t.orders_placed.groupBy("customer_id").agg(X.rows().alias("n"))
    busy = spent.filter(F.col("n") >= 12)
    placed = busy.join(t.customers, "customer_id").select("customer_state", "n")
    return placed.groupBy("customer_state").agg(X.rows().alias("customers"),
                                                F.sum("n").alias("orders"))


@query("b15_derived_table", """
    select n_orders, count(*) as customers
    from (select customer_id, count(*) as n_orders from s_orders group by customer_id) c
    group by n_orders""")
def _(t):
    per_customer = t.orders_placed.groupBy("customer_id").agg(X.rows().alias("n_orders"))
    return per_customer.groupBy("n_orders").agg(X.rows().alias("customers"))


@query("b16_scalar_subquery", """
    select order_id, order_purchase_ts from s_orders where order_purchase_ts >
        (select max(order_purchase_ts) from s_orders where order_status = 'shipped')
        - interval 10 day""")
def _(t):
    shipped = t.orders_placed.filter(F.col("order_status") == "shipped")
    newest = shipped.agg(F.max("order_purchase_ts")).scalar()
    return t.orders_placed.filter(
        F.col("order_purchase_ts") > newest - F.expr("interval 10 days")).select(
        "order_id", "order_purchase_ts")


@query("b17_all_except", """
    select order_id, customer_id, order_purchase_ts from s_orders""")
def _(t):
    return tables.except_columns(t.orders_placed, "order_status", "estimated_delivery_at")


@query("b18_status_route", """
    select order_id, case order_status when 'delivered' then 'OK' when 'canceled' then 'ALERT'
               when 'shipped' then 'INFO' when 'processing' then 'INFO' else 'UNKNOWN' end as route
    from s_orders""")
def _(t):
    return t.orders_placed.select("order_id", X.status_route("order_status").alias("route"))


# --- C joins --------------------------------------------------------------------

@query("c1_inner_join", """
    select o.order_id, o.order_status, c.customer_city, c.customer_state
    from s_orders o join s_customers c on c.customer_id = o.customer_id""")
def _(t):
    return t.orders_placed.join(t.customers, "customer_id").select(
        "order_id", "order_status", "customer_city", "customer_state")


@query("c2_left_join", """
    select i.order_id, i.order_item_id, p.product_category_name, cast(i.price as double) as price
    from s_order_items i left join (select * from s_products where product_weight_g > 25) p
         on p.product_id = i.product_id""")
def _(t):
    heavy = t.products.filter(F.col("product_weight_g") > 25)
    return t.order_items.join(heavy, "product_id", "left").select(
        "order_id", "order_item_id", "product_category_name",
        F.col("price").cast("double").alias("price"))


@query("c3_using_join", """
    select seller_id, order_id, seller_city, seller_state
    from s_order_items join s_sellers using (seller_id)""")
def _(t):
    joined = t.order_items.join(t.sellers, on="seller_id")
    return joined.select("seller_id", "order_id", "seller_city", "seller_state")


@query("c4_multi_way_join", """
    select c.customer_state, s.seller_state, count(*) as items,
           cast(sum(i.price) as double) as revenue
    from s_order_items i join s_orders o on o.order_id = i.order_id
         join s_customers c on c.customer_id = o.customer_id
         left join s_sellers s on s.seller_id = i.seller_id
    group by all""")
def _(t):
    routes = (t.order_items.select("order_id", "seller_id", "price")
              .join(t.orders_placed.select("order_id", "customer_id"), "order_id")
              .join(t.customers.select("customer_id", "customer_state"), "customer_id")
              .join(t.sellers.select("seller_id", "seller_state"), "seller_id", "left"))
    return routes.groupBy("customer_state", "seller_state").agg(
        X.rows().alias("items"), X.amount(F.sum("price")).alias("revenue"))


LOOKUP_SQL = """
    select p.product_id, t.product_category_name_english
    from s_products p left join s_translation t using (product_category_name)"""


@query("c5_broadcast_join", f"""
    select customer_id, case {" ".join(
        f"when customer_state in ({', '.join(repr(s) for s in group)}) then '{region}'"
        for region, group in STATES_BY_REGION.items())} end as region from s_customers""")
def _(t):
    """The hint is for the 27-row state seed; lookups that grow with data are left to AQE."""
    seed = state_regions(t.spark).withColumnRenamed("state", "customer_state")
    return joins.fixed_lookup_join(t.customers, seed, "customer_state").select("customer_id", "region")


@query("c5_lookup_join", LOOKUP_SQL)
def _(t):
    return joins.lookup_join(t.products, t.translation, "product_category_name").select(
        "product_id", "product_category_name_english")


@query("c6_unhinted_join", LOOKUP_SQL)
def _(t):
    return t.products.join(t.translation, "product_category_name", "left").select(
        "product_id", "product_category_name_english")


@query("c7_preaggregated_child", """
    select o.order_id, coalesce(i.n, 0) as n_items, cast(i.total as double) as items_total
    from s_orders o left join (select order_id, count(*) as n, sum(price) as total
                               from s_order_items group by order_id) i using (order_id)""")
def _(t):
    per_order = star.items_per_order(t.order_items)
    return t.orders_placed.select("order_id").join(per_order, "order_id", "left").select(
        "order_id", F.coalesce("item_count", F.lit(0)).alias("n_items"),
        F.col("items_total").cast("double").alias("items_total"))


@query("c8_deduplicated_pairs", """
    select product_id, count(*) as orders
    from (select distinct order_id, product_id from s_order_items)
         join (select order_id from s_orders where order_status = 'delivered') using (order_id)
    group by product_id""")
def _(t):
    pairs = t.order_items.select("order_id", "product_id").distinct()
    delivered = t.orders_placed.filter(F.col("order_status") == "delivered").select("order_id")
    return pairs.join(delivered, "order_id").groupBy("product_id").agg(X.rows().alias("orders"))


@query("c9_semi_filter", """
    select order_id, order_item_id, product_id from s_order_items
    where order_id in (select order_id from s_orders where order_status = 'canceled')""")
def _(t):
    canceled = t.orders_placed.filter(F.col("order_status") == "canceled").select("order_id")
    return t.order_items.join(canceled, "order_id", "left_semi").select(
        "order_id", "order_item_id", "product_id")


@query("c11_orphans", """
    select order_id from s_orders where order_id not in (select order_id from s_order_items)""")
def _(t):
    return joins.orphans(t.orders_placed.select("order_id"), t.order_items,
                         "order_id", "order_id")


# --- D aggregates -----------------------------------------------------------------

@query("d1_group_count", """
    select payment_type, count(*) as n from s_order_payments group by payment_type""")
def _(t):
    return t.order_payments.groupBy("payment_type").agg(X.rows().alias("n"))


@query("d2_count_column", """
    select order_status, count(*) as orders, count(delivered_at) as delivered
    from s_orders group by order_status""")
def _(t):
    return t.orders.groupBy("order_status").agg(X.rows().alias("orders"),
                                                F.count("delivered_at").alias("delivered"))


@query("d3_count_distinct", """
    select seller_id, count(distinct order_id) as orders, count(distinct product_id) as products
    from s_order_items group by seller_id""")
def _(t):
    return t.order_items.groupBy("seller_id").agg(
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct("product_id").alias("products"))


@query("d4_sum_avg_min_max", """
    select seller_id, cast(sum(price) as double) as total,
           round(cast(sum(price) as double) / count(price), 2) as mean,
           cast(min(price) as double) as low, cast(max(price) as double) as high
    from s_order_items group by seller_id""")
def _(t):
    price = F.col("price")
    return t.order_items.groupBy("seller_id").agg(
        X.amount(F.sum(price)).alias("total"),
        X.ratio(F.sum(price), F.count(price), 2).alias("mean"),
        F.min(price).cast("double").alias("low"), F.max(price).cast("double").alias("high"))


@query("d5_global_aggregate", """
    select count(*) as items, cast(sum(price) as double) as revenue,
           count(distinct seller_id) as sellers from s_order_items""")
def _(t):
    return t.order_items.agg(X.rows().alias("items"), X.amount(F.sum("price")).alias("revenue"),
                             F.countDistinct("seller_id").alias("sellers"))


@query("d6_having", """
    select customer_id, count(*) as n from s_orders group by customer_id having count(*) >= 15""")
def _(t):
    return (t.orders_placed.groupBy("customer_id").agg(X.rows().alias("n"))
            .filter(F.col("n") >= 15))


@query("d7_filter_on_aggregate", """
    with a as (select product_id, round(avg(review_score), 2) as avg_score,
                      count(review_id) as review_count
               from s_order_items join s_order_reviews using (order_id) group by product_id)
    select * from a where avg_score >= 3.5""")
def _(t):
    averages = explore.product_review_averages(t.order_items, t.order_reviews)
    return averages.filter(F.col("avg_score") >= 3.5)


@query("d8_conditional_aggregate", """
    select payment_type, count(*) filter (where payment_installments > 3) as long_plans,
           cast(sum(case when payment_installments > 3 then payment_value else 0 end) as double)
               as long_value
    from s_order_payments group by payment_type""")
def _(t):
    long_plan = F.col("payment_installments") > 3
    return t.order_payments.groupBy("payment_type").agg(
        F.count_if(long_plan).alias("long_plans"),
        X.amount(F.sum(F.when(long_plan, F.col("payment_value")).otherwise(0)))
        .alias("long_value"))


@query("d9_conditional_average", """
    select customer_id, round(avg(case when order_status = 'delivered' then
               date_diff('day', order_purchase_ts, delivered_at) end), 1) as delivered_days
    from s_orders group by customer_id""")
def _(t):
    days = F.when(F.col("order_status") == "delivered",
                  X.calendar_days("order_purchase_ts", "delivered_at"))
    return t.orders.groupBy("customer_id").agg(F.round(F.avg(days), 1).alias("delivered_days"))


@query("d10_safe_ratio", """
    select customer_id, round(count(*) filter (where delivered_at > estimated_delivery_at)
               / nullif(count(delivered_at), 0), 4) as late_rate,
           round(100.0 * count(delivered_at) / count(*), 2) as delivered_pct
    from s_orders where order_status = 'canceled' group by customer_id""")
def _(t):
    late = F.count_if(F.col("delivered_at") > F.col("estimated_delivery_at"))
    arrived = F.count("delivered_at")
    return t.orders.filter(F.col("order_status") == "canceled").groupBy("customer_id").agg(
        X.ratio(late, arrived, 4).alias("late_rate"),
        X.percent(arrived, X.rows(), 2).alias("delivered_pct"))


@query("d11_flag_rate", """
    select order_status, round(avg(case when delivered_at > estimated_delivery_at
               then 1 else 0 end), 4) as late_rate from s_orders group by order_status""")
def _(t):
    late = X.late_flag("delivered_at", "estimated_delivery_at")
    return t.orders.groupBy("order_status").agg(F.round(F.avg(late), 4).alias("late_rate"))


@query("d12_share_of_total", """
    select payment_type, count(*) as n,
           round(count(*) * 100.0 / sum(count(*)) over (), 1) as pct
    from s_order_payments group by payment_type""")
def _(t):
    counts = t.order_payments.groupBy("payment_type").agg(X.rows().alias("n"))
    return aggregates.share_of_total(counts, "n", "pct")


@query("d12_share_two_scans", """
    select payment_type, count(*) as n,
           round(count(*) * 100.0 / (select count(*) from s_order_payments), 1) as pct
    from s_order_payments group by payment_type""")
def _(t):
    total = t.order_payments.count()
    return t.order_payments.groupBy("payment_type").agg(
        X.rows().alias("n"), X.percent(X.rows(), F.lit(total), 1).alias("pct"))


@query("d13_group_by_expression", """
    select case when price > 50000 then 'high' else 'low' end as band, order_item_id % 2 as odd,
           count(*) as n from s_order_items group by 1, 2""")
def _(t):
    band = F.when(F.col("price") > 50000, "high").otherwise("low").alias("band")
    return t.order_items.groupBy(band, (F.col("order_item_id") % 2).alias("odd")).agg(
        X.rows().alias("n"))


@query("d14_group_by_month_text", """
    select strftime(order_purchase_ts, '%Y-%m') as month, count(*) as n from s_orders group by 1""")
def _(t):
    return t.orders_placed.groupBy(X.month_text("order_purchase_ts").alias("month")).agg(
        X.rows().alias("n"))


@query("d15_group_by_month_start", """
    select cast(date_trunc('month', shipping_limit_ts) as date) as month,
           cast(sum(price) as double) as revenue from s_order_items group by 1""")
def _(t):
    return t.order_items.groupBy(X.month_start("shipping_limit_ts").alias("month")).agg(
        X.amount(F.sum("price")).alias("revenue"))


@query("d16_rollup_to_order", """
    select order_id, count(*) as item_count, cast(sum(price) as double) as items_total,
           cast(sum(freight_value) as double) as freight_total
    from s_order_items group by order_id""")
def _(t):
    return star.items_per_order(t.order_items).withColumns({
        c: F.col(c).cast("double") for c in ("items_total", "freight_total")})


@query("d17_average_of_averages", """
    with o as (select order_id, seller_id, avg(review_score) as score
               from s_order_items join s_order_reviews using (order_id) group by all)
    select seller_id, round(avg(score), 2) as avg_order_score from o group by seller_id""")
def _(t):
    per_order = t.order_reviews.groupBy("order_id").agg(F.avg("review_score").alias("score"))
    sellers = t.order_items.select("order_id", "seller_id").distinct()
    return sellers.join(per_order, "order_id").groupBy("seller_id").agg(
        F.round(F.avg("score"), 2).alias("avg_order_score"))


@query("d18_salted_aggregate", """
    select customer_state, count(*) as rows, cast(count(delivered_at) as bigint) as delivered
    from s_orders join s_customers using (customer_id) group by customer_state""")
def _(t):
    located = t.orders.join(t.customers.select("customer_id", "customer_state"), "customer_id")
    return aggregates.salted_agg(located, ["customer_state"], {
        "delivered": F.col("delivered_at").isNotNull().cast("bigint")}, buckets=16)


@query("d19_duplicate_keys", """
    select review_id, count(*) as n from s_order_reviews where review_id is not null
    group by review_id having count(*) > 1""")
def _(t):
    return aggregates.duplicate_keys(t.order_reviews, ["review_id"])


@query("d20_distinct_values", """
    select count(distinct strftime(order_purchase_ts, '%Y-%m')) as months,
           count(distinct order_purchase_ts) as instants from s_orders""")
def _(t):
    return t.orders_placed.agg(
        F.countDistinct(X.month_text("order_purchase_ts")).alias("months"),
        F.countDistinct("order_purchase_ts").alias("instants"))


@query("d21_first_event_cohorts", """
    with f as (select customer_id, min(order_purchase_ts) as first from s_orders
               group by customer_id)
    select cast(date_trunc('month', first) as date) as cohort, count(*) as customers
    from f group by 1""")
def _(t):
    first = t.orders_placed.groupBy("customer_id").agg(F.min("order_purchase_ts").alias("first"))
    return first.groupBy(X.month_start("first").alias("cohort")).agg(
        X.rows().alias("customers"))


@query("d22_median_mode_deviation", """
    with counted as (select review_comment_message as message, review_score, count(*) as n
                     from s_order_reviews group by all)
    select r.review_comment_message as message, median(r.review_score) as median_score,
           (select min(review_score) from counted c where c.message = r.review_comment_message
                and c.n = (select max(n) from counted d where d.message = c.message))
               as mode_score,
           round(stddev_samp(r.review_score), 4) as score_deviation
    from s_order_reviews r group by r.review_comment_message""")
def _(t):
    # scores take five values, so the value counts behind median and mode stay tiny
    score = F.col("review_score")
    return t.order_reviews.groupBy(F.col("review_comment_message").alias("message")).agg(
        F.median(score).alias("median_score"),
        F.mode(score, deterministic=True).alias("mode_score"),
        F.round(F.stddev_samp(score), 4).alias("score_deviation"))


# --- E windows ---------------------------------------------------------------------

@query("e1_rank_keeps_ties", """
    with c as (select seller_id, product_id, count(*) as n from s_order_items group by all)
    select seller_id, product_id, n from c x where n =
        (select max(n) from c where seller_id = x.seller_id)""")
def _(t):
    counts = t.order_items.groupBy("seller_id", "product_id").agg(X.rows().alias("n"))
    return ranking.best_per_group(counts, ["seller_id"], "n")


@query("e2_latest_per_key", """
    select review_id, order_id, review_score, review_answer_timestamp from s_order_reviews
    qualify row_number() over (partition by review_id
                               order by review_answer_timestamp desc) = 1""")
def _(t):
    return ranking.latest_per_key(
        t.order_reviews.drop("review_comment_message"), ["review_id"],
        [F.desc("review_answer_timestamp")])


@query("e3_latest_with_tiebreak", """
    select order_id, order_item_id, product_id, seller_id from s_order_items
    qualify row_number() over (partition by order_id
        order by shipping_limit_ts desc, order_item_id, product_id, seller_id) = 1""")
def _(t):
    items = t.order_items.select("order_id", "order_item_id", "product_id", "seller_id",
                                 "shipping_limit_ts")
    return ranking.latest_per_key(items, ["order_id"], [
        F.desc("shipping_limit_ts"), F.asc("order_item_id"), F.asc("product_id"),
        F.asc("seller_id")]).drop("shipping_limit_ts")


@query("e4_global_row_number", """
    select customer_id, n as order_count,
           cast(row_number() over (order by n desc, customer_id) as int) as global_rank
    from (select customer_id, count(*) as n from s_orders group by customer_id)
    order by global_rank limit 20""")
def _(t):
    counts = t.orders_placed.groupBy("customer_id").agg(X.rows().alias("order_count"))
    return ranking.top_n(counts, 20, [F.desc("order_count"), F.asc("customer_id")],
                         rank="global_rank")


@query("e5_aggregate_over_result", """
    select order_status, count(*) as n, cast(sum(count(*)) over () as bigint) as total
    from s_orders group by order_status""")
def _(t):
    counts = t.orders_placed.groupBy("order_status").agg(X.rows().alias("n"))
    return counts.withColumn("total", counts.agg(F.sum("n")).scalar())


@query("e6_named_windows", """
    with m as (select customer_id, cast(date_trunc('month', order_purchase_ts) as date) as month,
                      count(*) as n from s_orders group by all)
    select customer_id, month, n, cast(dense_rank() over w as int) as place,
           cast(sum(n) over (partition by customer_id order by month) as bigint) as so_far,
           round(avg(n) over (partition by customer_id order by month), 4) as mean_so_far,
           lag(n) over (partition by customer_id order by month) as before,
           lead(n) over (partition by customer_id order by month) as after
    from m window w as (partition by customer_id order by n desc)""")
def _(t):
    """Windows run over months, so a customer has at most one row per month."""
    months = t.orders_placed.groupBy(
        "customer_id", X.month_start("order_purchase_ts").alias("month")).agg(
        X.rows().alias("n"))
    mine = Window.partitionBy("customer_id")
    time = mine.orderBy("month")
    return months.select(
        "customer_id", "month", "n",
        F.dense_rank().over(mine.orderBy(F.desc("n"))).alias("place"),
        F.sum("n").over(time).alias("so_far"),
        F.round(F.avg("n").over(time), 4).alias("mean_so_far"),
        F.lag("n").over(time).alias("before"), F.lead("n").over(time).alias("after"))


# --- F sorts and limits ---------------------------------------------------------------

@query("f1_order_by", """
    select customer_state, order_status, count(*) as n
    from s_orders join s_customers using (customer_id) group by all
    order by n desc, customer_state, order_status""")
def _(t):
    counts = (t.orders_placed.join(t.customers, "customer_id")
              .groupBy("customer_state", "order_status").agg(X.rows().alias("n")))
    return counts.orderBy(F.desc("n"), "customer_state", "order_status")


@query("f2_limit_sample", "select count(*) as n from (select * from s_order_items limit 20)")
def _(t):
    return t.order_items.limit(20).agg(X.rows().alias("n"))


@query("f3_top_k", """
    select order_id, order_purchase_ts from s_orders where order_status = 'delivered'
    order by order_purchase_ts desc, order_id limit 10""")
def _(t):
    delivered = t.orders_placed.filter(F.col("order_status") == "delivered")
    return ranking.top_n(delivered.select("order_id", "order_purchase_ts"), 10,
                         [F.desc("order_purchase_ts"), F.asc("order_id")])


@query("f4_top_n_with_threshold", """
    with s as (select seller_state, cast(sum(price) as double) as revenue
               from s_order_items join s_sellers using (seller_id) group by seller_state)
    select cast(row_number() over (order by revenue desc) as int) as place, seller_state, revenue
    from s where revenue >= 100000000 order by place limit 5""")
def _(t):
    revenue = (t.order_items.join(t.sellers, "seller_id").groupBy("seller_state")
               .agg(X.amount(F.sum("price")).alias("revenue")))
    return ranking.top_n(revenue, 5, [F.desc("revenue")], rank="place",
                         at_least=F.col("revenue") >= 100_000_000)
