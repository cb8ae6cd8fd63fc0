"""K1-K15: rules and table tests over the shaped tables."""

from pyspark.sql import functions as F

from tradewind.checks.registry import query
from tradewind.functions.domains import ORDER_STATUSES, PAYMENT_TYPES, STATES
from tradewind.operators import quality as Q
from tradewind.plans import model_tests


def outcome(count: str, severity: str = "error") -> str:
    bad = "warn" if severity == "warn" else "fail"
    return f"'{severity}' as severity, {count} as failing_rows, " \
           f"case when {count} = 0 then 'pass' else '{bad}' end as status"


def one_test(name: str, count_sql: str, severity: str = "error") -> str:
    return (f"with c as ({count_sql}) select '{name}' as test, "
            f"{outcome('n', severity)} from c")


DIRTY_RULES_SQL = """
    select 'cheap' as rule, 'drop' as action,
           count(*) filter (where not coalesce(price > 2000, false)) as violations
    from s_order_items
    union all
    select 'free_shipping', 'warn',
           count(*) filter (where price > 2000 and not coalesce(freight_value > 0, false))
    from s_order_items
    union all
    select 'order_known', 'fail', count(*) filter (where order_id is null) from s_order_items"""


def dirty_rules():
    return [Q.Rule("cheap", F.col("price") > 2000, Q.DROP),
            Q.Rule("free_shipping", F.col("freight_value") > 0, Q.WARN),
            Q.Rule("order_known", F.col("order_id").isNotNull(), Q.FAIL)]


@query("k1_warn_counts", DIRTY_RULES_SQL)
def _(t):
    return Q.expectation_report(t.order_items, dirty_rules())


@query("k2_dropped_rows", """
    select order_id, order_item_id, cast(price as double) as price from s_order_items
    where price > 2000""")
def _(t):
    return (Q.drop_violations(t.order_items, dirty_rules())
            .select("order_id", "order_item_id", F.col("price").cast("double").alias("price")))


@query("k3_fail_update", """
    select order_id, order_item_id, cast(price as double) as price from s_order_items
    where price > 2000""")
def _(t):
    """The fail rule is checked before the rows are handed on; here it holds."""
    kept, _ = Q.apply_expectations(t.order_items, dirty_rules())
    return kept.select("order_id", "order_item_id", F.col("price").cast("double").alias("price"))


@query("k4_closed_domains", f"""
    select 'valid_state' as rule, 'warn' as action, count(*) filter (
               where upper(customer_state) not in {STATES}) as violations from s_customers
    union all
    select 'valid_order_status', 'warn',
           count(*) filter (where order_status not in {ORDER_STATUSES}) from s_orders
    union all
    select 'valid_score', 'drop',
           count(*) filter (where review_score not between 1 and 5) from s_order_reviews
    union all
    select 'valid_price', 'drop', count(*) filter (where not price > 0) from s_order_items""")
def _(t):
    def report(df, name, condition, action):
        return Q.expectation_report(df, [Q.Rule(name, condition, action)])
    return (report(t.customers, "valid_state", F.upper("customer_state").isin(*STATES), Q.WARN)
            .unionByName(report(t.orders_placed, "valid_order_status",
                                F.col("order_status").isin(*ORDER_STATUSES), Q.WARN))
            .unionByName(report(t.order_reviews, "valid_score",
                                F.col("review_score").between(1, 5), Q.DROP))
            .unionByName(report(t.order_items, "valid_price", F.col("price") > 0, Q.DROP)))


@query("k5_not_null", one_test("orders.delivered_at not_null", """
    select count(*) as n from s_orders where delivered_at is null"""))
def _(t):
    return Q.run_tests({"orders": t.orders}, [Q.not_null("orders", "delivered_at")])


@query("k6_unique", one_test("order_reviews.review_id unique", """
    select count(*) as n from (select review_id from s_order_reviews where review_id is not null
                               group by review_id having count(*) > 1)"""))
def _(t):
    return Q.run_tests({"order_reviews": t.order_reviews}, [Q.unique("order_reviews", "review_id")])


@query("k7_unique_combination", one_test("order_items.order_id+order_item_id unique", """
    select count(*) as n from (select order_id from s_order_items
                               group by order_id, order_item_id having count(*) > 1)"""))
def _(t):
    return Q.run_tests({"order_items": t.order_items},
                       [Q.unique("order_items", "order_id", "order_item_id")])


@query("k8_accepted_values", one_test("order_payments.payment_type accepted_values", f"""
    select count(*) as n from s_order_payments where payment_type not in {PAYMENT_TYPES}"""))
def _(t):
    return Q.run_tests({"order_payments": t.order_payments}, [
        Q.accepted_values("order_payments", "payment_type", PAYMENT_TYPES)])


@query("k9_relationships", one_test("order_items.product_id references translated products", """
    select count(*) as n from s_order_items where product_id not in
        (select product_id from s_products where product_category_name is not null)"""))
def _(t):
    known = t.products.filter(F.col("product_category_name").isNotNull())
    return Q.run_tests(
        {"order_items": t.order_items, "translated products": known},
        [Q.relationship("order_items", "product_id", "translated products", "product_id")])


@query("k10_range", """
    select 'order_items.price in_range' as test, 'error' as severity,
           count(*) filter (where price < 1000 or price > 90000) as failing_rows,
           'fail' as status from s_order_items
    union all
    select 'order_items.freight_value in_range', 'error',
           count(*) filter (where freight_value < 0), 'pass' from s_order_items""")
def _(t):
    return Q.run_tests({"order_items": t.order_items}, [
        Q.in_range("order_items", "price", low=1000, high=90000),
        Q.in_range("order_items", "freight_value", low=0)])


@query("k11_not_in_future", one_test("orders.estimated_delivery_at not_in_future", """
    select count(*) as n from s_orders
    where estimated_delivery_at > timestamp '2000-01-01'"""))
def _(t):
    now = F.lit("2000-01-01").cast("timestamp_ntz")
    return Q.run_tests({"orders": t.orders_placed}, [
        Q.not_in_future("orders", "estimated_delivery_at", now)])


@query("k12_singular", one_test("no order lies in the future", """
    select count(*) as n from s_orders where order_purchase_ts > current_timestamp"""))
def _(t):
    return Q.run_tests({"orders": t.orders_placed}, [model_tests.no_future_orders()])


@query("k13_severity_warn", one_test("order_reviews.review_score accepted_values", """
    select count(*) as n from s_order_reviews where review_score not in (2, 3, 4, 5)""", "warn"))
def _(t):
    return Q.run_tests({"order_reviews": t.order_reviews}, [
        Q.accepted_values("order_reviews", "review_score", (2, 3, 4, 5), severity=Q.WARN)])


@query("k14_freshness", one_test("orders.order_purchase_ts fresh", """
    select cast(max(order_purchase_ts) < current_timestamp - interval 24 hour as bigint) as n
    from s_orders""", "warn"))
def _(t):
    return Q.run_tests({"orders": t.orders_placed}, [Q.fresh("orders", "order_purchase_ts", 24)])


@query("k15_staging_gate", """
    select 'orders' as name, count(*) as n from s_orders
    union all select 'customers', count(*) from s_customers""")
def _(t):
    """Tests of one layer pass before the next layer is built."""
    tables = {"orders": t.orders_placed, "customers": t.customers}
    Q.require_passing(tables, [
        *model_tests.key("orders", "order_id"), *model_tests.key("customers", "customer_id"),
        Q.accepted_values("orders", "order_status", ORDER_STATUSES),
        Q.relationship("orders", "customer_id", "customers", "customer_id")])
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
              for name, df in tables.items()]
    return counts[0].unionByName(counts[1])
