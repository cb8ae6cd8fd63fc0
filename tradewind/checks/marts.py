"""N16-N43: staging, silver, star and gold tables, with independent SQL."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.checks.registry import MODEL_SQL, query
from tradewind.checks.shapes import Retail
from tradewind.operators import changes
from tradewind.operators.quality import apply_expectations, drop_violations
from tradewind.plans import gold, silver, staging, star

MODEL_SQL.update({
    "m_items": """
        select order_id, count(*) as item_count, sum(price) as items_total,
               sum(freight_value) as freight_total
        from s_order_items group by order_id""",
    "m_payments": """
        select order_id, cast(sum(payment_value) as double) as total_paid,
               count(*) as n_payment_rows, max(payment_installments) as max_installments
        from s_order_payments group by order_id""",
    # all money of an order from one list of its item and payment lines
    "m_money": """
        select order_id, count(price) as item_count, coalesce(sum(price), 0) as items_total,
               coalesce(sum(freight_value), 0) as freight_total,
               coalesce(sum(price + freight_value), 0) as order_total,
               cast(sum(payment_value) as double) as total_paid,
               max(payment_installments) as max_installments
        from (select order_id, price, freight_value from s_order_items
              union all by name
              select order_id, payment_value, payment_installments from s_order_payments)
        group by order_id""",
    "m_enriched": """
        select s_orders.*, who.* exclude (customer_id),
               coalesce(m.item_count, 0) as item_count, coalesce(m.items_total, 0) as items_total,
               coalesce(m.freight_total, 0) as freight_total,
               coalesce(m.order_total, 0) as order_total, m.total_paid, m.max_installments,
               date_diff('day', order_purchase_ts, delivered_at) as days_to_deliver,
               case when delivered_at > estimated_delivery_at then 1 else 0 end as is_late
        from m_money m right join s_orders using (order_id)
             left join s_customers who using (customer_id)""",
    "m_people": """
        select customer_unique_id, count(*) as n_orders, sum(order_total) as lifetime_value,
               min(order_purchase_ts) as first_order_ts, max(order_purchase_ts) as last_order_ts,
               first(customer_state order by order_purchase_ts desc, customer_state,
                     customer_city) as customer_state,
               first(customer_city order by order_purchase_ts desc, customer_state,
                     customer_city) as customer_city
        from m_enriched group by customer_unique_id""",
    "m_labels": """
        select p.product_id, p.product_category_name, p.product_weight_g,
               t.product_category_name_english,
               coalesce(t.product_category_name_english, p.product_category_name, 'unknown')
                   as category
        from s_products p left join s_translation t
             on t.product_category_name = p.product_category_name""",
    "m_order_scores": """
        select order_id, round(avg(review_score), 2) as avg_review_score, count(*) as n_reviews
        from s_order_reviews group by order_id""",
    # landed reviews after cleaning: unreadable scores are gone
    "m_reviews": """
        select review_id, order_id, review_score, trim(review_comment_message) as title,
               case when review_score > 1 then trim(review_comment_message) else '' end as message,
               review_answer_timestamp
        from s_order_reviews where order_id % 11 <> 0""",
    "m_last_reviews": """
        select * from m_reviews
        qualify row_number() over (partition by review_id
                                   order by review_answer_timestamp desc) = 1""",
})


def enriched(t: Retail) -> DataFrame:
    return star.orders_enriched(t.orders, t.customers, t.order_items, t.order_payments)


def fact(t: Retail) -> DataFrame:
    return star.fact_orders(enriched(t))


def labels(t: Retail) -> DataFrame:
    return star.product_labels(t.products, t.translation)


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def naive(df: DataFrame) -> DataFrame:
    """Instants without a zone, as the given tables carry them."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema
                           if f.dataType.typeName() == "timestamp"})


# --- N31 staging ---------------------------------------------------------------

@query("n31_stg_orders", """
    select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id,
           order_status, order_purchase_ts, order_purchase_ts as approved_at,
           delivered_at as shipped_at, delivered_at, estimated_delivery_at
    from s_orders""")
def _(t):
    return naive(staging.orders(t.landed_orders))


@query("n31_stg_order_items", """
    select cast(order_id as varchar) as order_id, order_item_id,
           cast(product_id as varchar) as product_id, cast(seller_id as varchar) as seller_id,
           cast(price as double) as price, cast(freight_value as double) as freight_value,
           shipping_limit_ts
    from s_order_items""")
def _(t):
    return naive(doubles(staging.order_items(t.landed_order_items), "price", "freight_value"))


@query("n31_stg_order_payments", """
    select cast(order_id as varchar) as order_id, payment_sequential, payment_type,
           payment_installments, cast(payment_value as double) as payment_value
    from s_order_payments""")
def _(t):
    return staging.order_payments(t.landed_order_payments)


@query("n31_stg_order_reviews", """
    select cast(review_id as varchar) as review_id, cast(order_id as varchar) as order_id,
           review_score, review_answer_timestamp as review_created_at,
           review_answer_timestamp as review_answered_at
    from m_reviews""")
def _(t):
    return naive(staging.order_reviews(t.landed_order_reviews))


@query("n31_stg_customers", """
    select cast(customer_id as varchar) as customer_id,
           cast(customer_unique_id as varchar) as customer_unique_id,
           cast(customer_id % 1000 as varchar) as zip_code,
           ' ' || lower(customer_city) as customer_city,
           lower(customer_state) || ' ' as customer_state
    from s_customers""")
def _(t):
    return staging.customers(t.landed_customers)


@query("n31_stg_products", """
    select cast(product_id as varchar) as product_id, product_category_name, product_weight_g,
           product_weight_g + 3 as product_length_cm, product_weight_g + 4 as product_height_cm,
           product_weight_g + 5 as product_width_cm
    from s_products""")
def _(t):
    return staging.products(t.landed_products)


@query("n31_stg_sellers", """
    select cast(seller_id as varchar) as seller_id, cast(seller_id % 100 as varchar) as zip_code,
           ' ' || lower(seller_city) as seller_city, lower(seller_state) || ' ' as seller_state
    from s_sellers""")
def _(t):
    return staging.sellers(t.landed_sellers)


# --- N16 append silver (batch form) ----------------------------------------------

def _append(table, landed):
    return drop_violations(silver.APPEND_TRACK[table](landed), silver.append_rules()[table])


@query("n16_append_orders", """
    select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id,
           order_status, order_purchase_ts, order_purchase_ts as approved_at,
           estimated_delivery_at as estimated_delivery_ts, delivered_at
    from s_orders""")
def _(t):
    return naive(_append("orders", t.landed_orders))


@query("n16_append_order_items", """
    select cast(order_id as varchar) as order_id, cast(order_item_id as varchar) as order_item_id,
           cast(product_id as varchar) as product_id, cast(seller_id as varchar) as seller_id,
           cast(price as double) as price, cast(freight_value as double) as freight_value,
           round(cast(price as double) + cast(freight_value as double), 4) as price_with_freight
    from s_order_items""")
def _(t):
    return _append("order_items", t.landed_order_items).withColumn(
        "price_with_freight", F.round("price_with_freight", 4))


@query("n16_append_products", """
    select cast(product_id as varchar) as product_id, product_category_name,
           cast(product_weight_g + 1 as varchar) as product_name_lenght,
           cast(product_weight_g + 2 as varchar) as product_description_lenght,
           cast(product_weight_g % 5 as varchar) as product_photos_qty,
           cast(product_weight_g as varchar) as product_weight_g,
           cast(product_weight_g + 3 as varchar) as product_length_cm,
           cast(product_weight_g + 4 as varchar) as product_height_cm,
           cast(product_weight_g + 5 as varchar) as product_width_cm
    from s_products""")
def _(t):
    return _append("products", t.landed_products)


@query("n16_append_sellers", """
    select cast(seller_id as varchar) as seller_id,
           cast(seller_id % 100 as varchar) as seller_zip_code_prefix,
           ' ' || lower(seller_city) as seller_city, lower(seller_state) || ' ' as seller_state
    from s_sellers""")
def _(t):
    return _append("sellers", t.landed_sellers)


@query("n16_append_order_reviews", """
    select cast(order_id as varchar) as order_id,
           case when order_id % 11 <> 0 then review_score end as review_score,
           review_answer_timestamp as review_ts
    from s_order_reviews""")
def _(t):
    return naive(_append("order_reviews", t.landed_order_reviews))


# --- N17-N22 change silver (batch form) --------------------------------------------

def _current(table, staged, sequence_by=None):
    spec = silver.change_tables()[table]
    kept, _ = apply_expectations(staged, spec.rules)  # a violated fail rule stops here
    return changes.scd1(kept, spec.keys, sequence_by or spec.sequence_by,
                        ignore_null_updates=True)


def _arrived(landed: DataFrame, instant) -> DataFrame:
    """Ingestion time taken from the data, so both engines know it."""
    return landed.withColumn(silver.INGESTED, instant)


@query("n17_slv_customers", """
    select cast(customer_id as varchar) as customer_id,
           cast(customer_unique_id as varchar) as customer_unique_id,
           cast(customer_id % 1000 as varchar) as customer_zip_code_prefix,
           upper(customer_city) as customer_city, upper(customer_state) as customer_state
    from s_customers""")
def _(t):
    staged = silver.customers_staged(_arrived(t.landed_customers, F.lit(0)))
    return _current("customers", staged).drop(silver.INGESTED)


@query("n18_slv_order_items", """
    with staged as (
        select *, shipping_limit_ts + to_seconds(product_id) as arrived from s_order_items
        where price > 0)
    select cast(order_id as varchar) as order_id, order_item_id,
           cast(product_id as varchar) as product_id, cast(seller_id as varchar) as seller_id,
           shipping_limit_ts as shipping_limit_date, cast(price as double) as price,
           cast(freight_value as double) as freight_value,
           round(cast(price as double) + cast(freight_value as double), 4) as total_item_value
    from staged qualify row_number() over (
        partition by order_id, order_item_id order by arrived desc) = 1""")
def _(t):
    arrived = F.timestamp_add("SECOND", F.col("product_id").cast("int"),
                              F.to_timestamp("shipping_limit_date"))
    staged = silver.order_items_staged(_arrived(t.landed_order_items, arrived))
    return naive(_current("order_items", staged).drop(silver.INGESTED).withColumn(
        "total_item_value", F.round("total_item_value", 4)))


SLV_ORDERS_SQL = """
    select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id,
           order_status, order_purchase_ts as order_purchase_timestamp,
           order_purchase_ts as order_approved_at, delivered_at as order_delivered_carrier_date,
           delivered_at as order_delivered_customer_date,
           estimated_delivery_at as order_estimated_delivery_date,
           cast(date_diff('day', order_purchase_ts, delivered_at) as int) as delivery_days,
           delivered_at <= estimated_delivery_at as is_on_time
    from s_orders"""


@query("n19_slv_orders", SLV_ORDERS_SQL)
def _(t):
    staged = silver.orders_staged(_arrived(t.landed_orders, F.lit(0)))
    return naive(_current("orders", staged).drop(silver.INGESTED))


@query("n20_slv_products", """
    select cast(product_id as varchar) as product_id, product_category_name,
           product_category_name_english, product_weight_g + 1 as product_name_length,
           product_weight_g + 2 as product_description_length,
           product_weight_g % 5 as product_photos_qty,
           cast(product_weight_g as double) as product_weight_g,
           cast(product_weight_g + 3 as double) as product_length_cm,
           cast(product_weight_g + 4 as double) as product_height_cm,
           cast(product_weight_g + 5 as double) as product_width_cm
    from m_labels""")
def _(t):
    staged = silver.products_staged(_arrived(t.landed_products, F.lit(0)), t.translation)
    return _current("products", staged).drop(silver.INGESTED)


@query("n21_slv_reviews", """
    select cast(review_id as varchar) as review_id, cast(order_id as varchar) as order_id,
           review_score, title as review_comment_title, message as review_comment_message,
           review_answer_timestamp as review_creation_date, review_answer_timestamp,
           message <> '' as has_comment
    from m_last_reviews""")
def _(t):
    staged = silver.reviews_staged(_arrived(
        t.landed_order_reviews, F.to_timestamp("review_answer_timestamp")))
    return naive(_current("reviews", staged).drop(silver.INGESTED))


@query("n22_slv_sellers", """
    select cast(seller_id as varchar) as seller_id,
           cast(seller_id % 100 as varchar) as seller_zip_code_prefix,
           upper(seller_city) as seller_city, upper(seller_state) as seller_state
    from s_sellers""")
def _(t):
    staged = silver.sellers_staged(_arrived(t.landed_sellers, F.lit(0)))
    return _current("sellers", staged).drop(silver.INGESTED)


# --- N25-N27 gold of the append track -------------------------------------------------

@query("n25_monthly_revenue", """
    select coalesce(t.product_category_name_english, p.product_category_name) as category,
           cast(date_trunc('month', o.order_purchase_ts) as date) as month,
           cast(sum(i.price) as double) as revenue, count(distinct i.order_id) as order_count
    from s_order_items i join s_orders o on o.order_id = i.order_id
         join s_products p on p.product_id = i.product_id
         left join s_translation t on t.product_category_name = p.product_category_name
    where o.order_status = 'delivered' group by all""")
def _(t):
    return gold.monthly_revenue(t.order_items, t.orders_placed, t.products, t.translation)


@query("n26_delivery_by_seller_state", """
    with lines as (
        select s.seller_state, date_sub('day', o.order_purchase_ts, o.delivered_at) as days,
               o.delivered_at <= o.estimated_delivery_at as on_time
        from s_order_items i join s_orders o on o.order_id = i.order_id
             join s_sellers s on s.seller_id = i.seller_id
        where o.order_status = 'delivered' and o.delivered_at is not null)
    select seller_state, count(*) as total_orders, round(avg(days), 1) as avg_delivery_days,
           round(100.0 * count(*) filter (where not on_time) / count(*), 2) as late_pct,
           round(100.0 * count(*) filter (where on_time) / count(*), 2) as on_time_pct
    from lines group by seller_state""")
def _(t):
    return gold.delivery_by_seller_state(t.orders, t.order_items, t.sellers)


@query("n27_seller_review_scores", """
    select s.seller_id, s.seller_city, s.seller_state, round(avg(r.review_score), 2)
               as avg_review_score, count(*) as total_reviews,
           round(100.0 * count(*) filter (where r.review_score = 5) / count(*), 1) as pct_5_star
    from s_order_items i join s_order_reviews r on r.order_id = i.order_id
         join s_sellers s on s.seller_id = i.seller_id
    where r.review_score is not null group by all having count(*) >= 10""")
def _(t):
    return gold.seller_review_scores(t.order_items, t.order_reviews, t.sellers)


# --- N28-N30 gold of the change track --------------------------------------------------

def silver_orders(t):
    return t.orders.select(
        "order_id", "order_status", F.col("order_purchase_ts").alias("order_purchase_timestamp"),
        F.datediff("delivered_at", "order_purchase_ts").alias("delivery_days"),
        (F.col("delivered_at") <= F.col("estimated_delivery_at")).alias("is_on_time"))


@query("n28_monthly_delivery", """
    with o as (select *, delivered_at <= estimated_delivery_at as on_time,
                      date_diff('day', order_purchase_ts, delivered_at) as days from s_orders)
    select strftime(order_purchase_ts, '%Y-%m') as order_month, count(*) as order_count,
           count(*) filter (where order_status = 'delivered') as delivered_count,
           count(*) filter (where order_status = 'canceled') as canceled_count,
           round(avg(days) filter (where order_status = 'delivered'), 1) as avg_delivery_days,
           round(count(*) filter (where on_time) / nullif(count(on_time), 0), 4) as on_time_rate,
           count(*) filter (where not on_time) as late_delivery_count
    from o group by 1""")
def _(t):
    return gold.monthly_delivery(silver_orders(t))


@query("n29_category_totals", """
    select coalesce(l.product_category_name_english, 'uncategorized') as category,
           cast(sum(i.price + i.freight_value) as double) as total_revenue,
           cast(sum(i.price) as double) as total_product_revenue,
           cast(sum(i.freight_value) as double) as total_freight_revenue,
           count(distinct i.order_id) as order_count, count(*) as item_count,
           round(cast(sum(i.price + i.freight_value) as double) / count(*), 2) as avg_item_value
    from s_order_items i join s_orders o on o.order_id = i.order_id
         left join m_labels l on l.product_id = i.product_id
    where o.order_status = 'delivered' group by 1""")
def _(t):
    items = t.order_items.withColumn("total_item_value", F.col("price") + F.col("freight_value"))
    return gold.category_totals(items, t.orders_placed, labels(t))


@query("n30_category_review_scores", """
    with r as (
        select coalesce(l.product_category_name_english, 'uncategorized') as category,
               v.review_id, v.review_score, v.review_comment_message <> '' as has_comment
        from s_order_reviews v join s_orders o on o.order_id = v.order_id
             join (select distinct order_id, product_id from s_order_items) i
                  on i.order_id = v.order_id
             left join m_labels l on l.product_id = i.product_id)
    select category, count(review_id) as review_count, round(avg(review_score), 3) as avg_score,
           round(count(*) filter (where review_score = 5) / count(*), 4) as pct_5_stars,
           round(count(*) filter (where review_score = 1) / count(*), 4) as pct_1_stars,
           count(*) filter (where has_comment) as reviews_with_comment
    from r group by category""")
def _(t):
    reviews = t.order_reviews.withColumn(
        "has_comment", F.length(F.trim("review_comment_message")) > 0)
    return gold.category_review_scores(reviews, t.orders_placed, t.order_items, labels(t))


# --- N32-N43 star schema and its gold ---------------------------------------------------

@query("n32_int_order_payments", "select * from m_payments")
def _(t):
    return star.payments_per_order(t.order_payments)


@query("n33_int_order_reviews", "select * from m_order_scores")
def _(t):
    return star.reviews_per_order(t.order_reviews)


ENRICHED_MONEY = ("items_total", "freight_total", "order_total")
ENRICHED_COLUMNS = """customer_id, customer_unique_id, customer_state, customer_city,
    order_status, order_purchase_ts, delivered_at, estimated_delivery_at, item_count,
    cast(items_total as double) as items_total, cast(freight_total as double) as freight_total,
    cast(order_total as double) as order_total, total_paid, max_installments, days_to_deliver,
    is_late"""


@query("n34_int_orders_enriched", f"select order_id, {ENRICHED_COLUMNS} from m_enriched")
def _(t):
    return doubles(enriched(t), *ENRICHED_MONEY)


@query("n35_fct_orders", f"""
    select md5(cast(order_id as varchar)) as order_sk, order_id, {ENRICHED_COLUMNS}
    from m_enriched""")
def _(t):
    return doubles(fact(t), *ENRICHED_MONEY)


@query("n36_dim_customers", """
    select md5(cast(customer_unique_id as varchar)) as customer_sk, customer_unique_id,
           customer_state, customer_city, n_orders,
           cast(lifetime_value as double) as lifetime_value, first_order_ts, last_order_ts,
           n_orders > 1 as is_repeat_customer
    from m_people""")
def _(t):
    return doubles(star.dim_customers(enriched(t)), "lifetime_value")


@query("n37_dim_products", """
    select md5(cast(product_id as varchar)) as product_sk, product_id, category,
           product_category_name as category_pt, product_weight_g from m_labels""")
def _(t):
    return star.dim_products(t.products, t.translation)


@query("n38_delivery_by_customer_state", """
    with arrived as (
        select customer_id, date_diff('day', order_purchase_ts, delivered_at) as days,
               delivered_at > estimated_delivery_at as late
        from s_orders where order_status = 'delivered' and delivered_at is not null)
    select customer_state, region, count(*) as delivered_orders,
           round(sum(days) / count(*), 1) as avg_delivery_days,
           round(count_if(late) * 100.0 / count(*), 1) as late_pct,
           round(count_if(not late) * 100.0 / count(*), 1) as on_time_pct
    from arrived join s_customers using (customer_id)
         left join s_regions on state = customer_state
    group by customer_state, region""")
def delivery_by_customer_state(t):
    return gold.delivery_by_customer_state(fact(t), t.regions)


@query("n39_monthly_revenue_star", """
    with baskets as (
        select order_id, sum(price) as price,
               (select category from m_labels l where l.product_id = i.product_id) as category
        from s_order_items i group by order_id, 3)
    select category, cast(date_trunc('month', order_purchase_ts) as date) as order_month,
           count(*) as order_count, cast(sum(price) as double) as revenue
    from baskets semi join (select order_id from s_orders where order_status = 'delivered') using (order_id)
         join s_orders using (order_id)
    group by 1, 2""")
def _(t):
    return gold.monthly_revenue_star(t.order_items, fact(t), labels(t))


@query("n40_seller_scorecard", """
    with sold as (
        select i.seller_id, i.order_id, i.price,
               date_diff('day', o.order_purchase_ts, o.delivered_at) as days,
               o.delivered_at > o.estimated_delivery_at is true as late,
               (select round(avg(review_score), 2) from s_order_reviews r
                where r.order_id = i.order_id) as score
        from s_order_items i semi join s_sellers s on s.seller_id = i.seller_id
             join s_orders o on o.order_id = i.order_id and o.order_status = 'delivered')
    select seller_id, any_value(seller_state) as seller_state,
           count(distinct order_id) as n_orders, cast(sum(price) as double) as revenue,
           round(avg(days), 1) as avg_delivery_days,
           round(count_if(late) * 100.0 / count(*), 1) as late_pct,
           round(count_if(not late) * 100.0 / count(*), 1) as on_time_pct,
           round(avg(score), 2) as avg_review_score
    from sold join s_sellers using (seller_id) group by seller_id""")
def _(t):
    return gold.seller_scorecard(t.order_items, fact(t), t.sellers,
                                 star.reviews_per_order(t.order_reviews))


@query("n41_customer_cohorts", """
    with orders as (
        select order_purchase_ts as placed, coalesce((select sum(price + freight_value) from s_order_items i
                                                  where i.order_id = o.order_id), 0) as total,
               (select customer_unique_id from s_customers c where c.customer_id = o.customer_id) as person
        from s_orders o),
    ranked as (
        select date_trunc('month', min(placed) over whole)::date as cohort_month, total,
               row_number() over (partition by person order by placed) as nth
        from orders window whole as (partition by person))
    select cohort_month, count(*) filter (where nth = 1) as n_customers,
           count(*) filter (where nth = 2) as n_repeat_customers,
           round(100.0 * n_repeat_customers / n_customers, 2) as repeat_customer_pct,
           round(sum(total)::double / n_customers, 2) as avg_lifetime_value
    from ranked group by cohort_month""")
def _(t):
    return gold.customer_cohorts(star.dim_customers(enriched(t)))


@query("n42_review_sentiment", """
    with shelves as (
        select category, list(distinct order_id) as orders
        from s_order_items left join m_labels using (product_id) group by category),
    told as (
        select category, review_score as score
        from (select category, unnest(orders) as order_id from shelves) join s_order_reviews using (order_id))
    select category, count(score) as n_reviews, round(avg(score), 2) as avg_review_score,
           round(avg(100.0 * (score = 1)::int), 1) as pct_1_star,
           round(avg(100.0 * (score = 5)::int), 1) as pct_5_star
    from told group by category""")
def _(t):
    return gold.review_sentiment_by_category(t.order_items, labels(t), t.order_reviews)


@query("n43_orders_snapshot", """
    with was as (select order_id, 'shipped' as order_status, order_purchase_ts from s_orders),
         now as (select order_id, order_status, order_purchase_ts from s_orders)
    select w.*, timestamp '2024-01-01' as valid_from,
           case when n.order_status <> w.order_status then timestamp '2024-01-02' end as valid_to
    from was w join now n on n.order_id = w.order_id
    union all
    select n.*, timestamp '2024-01-02', null from now n where n.order_status <> 'shipped'""")
def _(t):
    """Two runs: everything was shipped yesterday, today it has its real status."""
    now = t.orders_placed.select("order_id", "order_status", "order_purchase_ts")
    was = now.withColumn("order_status", F.lit("shipped"))

    def day(n):
        return F.lit(f"2024-01-0{n}").cast("timestamp_ntz")
    first = changes.snapshot_check(None, was, ["order_id"], ["order_status"], day(1))
    return changes.snapshot_check(first, now, ["order_id"], ["order_status"], day(2))
