"""N1-N14, N44, N45: the exploration questions, with independent SQL."""

from pyspark.sql import functions as F

from tradewind.checks.registry import query
from tradewind.plans import explore


@query("n1_status_distribution", """
    select order_status, count(*) as order_count from s_orders group by order_status""")
def _(t):
    return explore.status_distribution(t.orders_placed)


@query("n2_delivery_time_stats", """
    with d as (select date_diff('day', order_purchase_ts, delivered_at) as days
               from s_orders where delivered_at is not null)
    select round(avg(days), 1) as avg_delivery_days, cast(min(days) as int) as min_delivery_days,
           cast(max(days) as int) as max_delivery_days from d""")
def _(t):
    return explore.delivery_time_stats(t.orders)


@query("n3_top_category_revenue", """
    select coalesce(product_category_name, 'unknown') as category,
           cast(sum(price) as double) as total_revenue,
           count(distinct order_id) as order_count
    from s_order_items left join s_products using (product_id)
    group by 1 order by total_revenue desc, category limit 10""")
def _(t):
    return explore.category_revenue(t.order_items, t.products)


@query("n4_review_score_share", """
    with scores as (select review_score, count(*) as review_count
                    from s_order_reviews group by 1)
    select review_score, review_count,
           round(review_count * 100.0 / (select count(*) from s_order_reviews), 1) as pct
    from scores""")
def _(t):
    return explore.review_score_share(t.order_reviews)


@query("n5_late_rate_by_state", """
    with d as (select customer_state, delivered_at > estimated_delivery_at as late
               from s_orders left join s_customers using (customer_id)
               where delivered_at is not null)
    select customer_state, count(*) as delivered_count,
           count(*) filter (where late) as late_count,
           round(100.0 * count(*) filter (where late) / count(*), 2) as late_pct
    from d group by customer_state""")
def _(t):
    return explore.late_rate_by_state(t.orders, t.customers)


@query("n6_favourite_payment_by_state", """
    with counted as (
        select customer_state, payment_type, count(*) as payment_count
        from s_order_payments join s_orders using (order_id)
             join s_customers using (customer_id)
        group by all)
    select * from counted c where payment_count =
        (select max(payment_count) from counted where customer_state = c.customer_state)""")
def _(t):
    return explore.favourite_payment_by_state(t.order_payments, t.orders_placed, t.customers)


@query("n7_orders_by_state", """
    select customer_state, count(distinct order_id) as order_count
    from s_orders join s_customers using (customer_id) group by customer_state""")
def _(t):
    return explore.orders_by_state(t.orders_placed, t.customers)


@query("n8_top_products", """
    select product_id, product_category_name, cast(sum(price) as double) as total_revenue
    from s_order_items left join s_products using (product_id)
    group by all order by total_revenue desc, product_id limit 5""")
def _(t):
    return explore.top_products(t.order_items, t.products)


@query("n9_top_seller_states", """
    select seller_state, cast(sum(price) as double) as total_revenue,
           count(distinct order_id) as order_count
    from s_order_items join s_sellers using (seller_id)
    group by seller_state order by total_revenue desc, seller_state limit 10""")
def _(t):
    return explore.top_seller_states(t.order_items, t.sellers)


@query("n10_payment_stats", """
    select payment_type, count(*) as payment_count,
           round(cast(sum(payment_value) as double) / count(payment_value), 2)
               as avg_payment_value
    from s_order_payments group by payment_type""")
def _(t):
    return explore.payment_stats(t.order_payments)


@query("n11_frequent_products", """
    select product_id, count(*) as item_count from s_order_items
    group by product_id having count(*) > 30 order by item_count desc, product_id limit 20""")
def _(t):
    return explore.frequent_products(t.order_items, more_than=30)


@query("n12_well_reviewed_products", """
    with scored as (
        select product_id, round(avg(review_score), 2) as avg_score,
               count(review_id) as review_count
        from s_order_items join s_order_reviews using (order_id) group by product_id)
    select * from scored where avg_score >= 4.0
    order by avg_score desc, review_count desc, product_id limit 20""")
def _(t):
    return explore.well_reviewed_products(t.order_items, t.order_reviews)


@query("n13_top_customers_by_state", """
    with counted as (
        select customer_unique_id, customer_state, count(*) as order_count
        from s_orders join s_customers using (customer_id) group by all)
    select *, 1 as state_rank from counted c where order_count =
        (select max(order_count) from counted where customer_state = c.customer_state)""")
def _(t):
    return explore.top_customers_by_state(t.orders_placed, t.customers)


@query("n14_items_with_english_category", """
    select order_id, product_id, product_category_name, product_category_name_english,
           cast(price as double) as price
    from s_order_items left join s_products using (product_id)
         left join s_translation using (product_category_name)""")
def _(t):
    df = explore.items_with_english_category(t.order_items, t.products, t.translation)
    return df.withColumn("price", F.col("price").cast("double"))


@query("n44_populous_states", """
    select customer_state, count(*) as customer_count from s_customers
    group by customer_state having count(*) > 50""")
def _(t):
    return explore.populous_states(t.customers, more_than=50)


@query("n45_busiest_states", """
    select customer_state, count(distinct order_id) as order_count
    from s_orders join s_customers using (customer_id)
    group by customer_state order by order_count desc, customer_state limit 10""")
def _(t):
    return explore.busiest_states(t.orders_placed, t.customers)
