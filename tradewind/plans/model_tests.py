"""The tests of the model tables, by layer."""

from __future__ import annotations

from tradewind.functions.domains import ORDER_STATUSES, PAYMENT_TYPES, REVIEW_SCORES
from tradewind.operators.quality import (WARN, TableTest, accepted_values, fresh, in_range,
                                         not_in_future, not_null, relationship,
                                         returns_no_rows, unique)


def key(table: str, column: str) -> list[TableTest]:
    return [not_null(table, column), unique(table, column)]


def source_tests(now=None) -> list[TableTest]:
    return [
        *key("orders", "order_id"), *key("customers", "customer_id"),
        *key("products", "product_id"), *key("sellers", "seller_id"),
        *key("translation", "product_category_name"),
        not_null("order_items", "order_id"), unique("order_items", "order_id", "order_item_id"),
        not_null("order_payments", "order_id"),
        unique("order_payments", "order_id", "payment_sequential"),
        not_null("order_reviews", "review_id", severity=WARN),
        fresh("orders", "order_purchase_ts", 24, now),
    ]


def staging_tests() -> list[TableTest]:
    return [
        *key("orders", "order_id"), not_null("orders", "customer_id"),
        relationship("orders", "customer_id", "customers", "customer_id"),
        accepted_values("orders", "order_status", ORDER_STATUSES),
        not_null("order_items", "order_id"), not_null("order_items", "price"),
        relationship("order_items", "order_id", "orders", "order_id"),
        not_null("order_payments", "order_id"), not_null("order_payments", "payment_value"),
        relationship("order_payments", "order_id", "orders", "order_id"),
        accepted_values("order_payments", "payment_type", PAYMENT_TYPES),
        unique("order_payments", "order_id", "payment_sequential"),
        *key("customers", "customer_id"), *key("products", "product_id"),
        *key("sellers", "seller_id"),
        not_null("order_reviews", "review_id"), not_null("order_reviews", "order_id"),
        relationship("order_reviews", "order_id", "orders", "order_id"),
        accepted_values("order_reviews", "review_score", REVIEW_SCORES),
        no_future_orders(),
    ]


def intermediate_tests() -> list[TableTest]:
    return [
        *key("payments_per_order", "order_id"), not_null("payments_per_order", "total_paid"),
        *key("reviews_per_order", "order_id"),
        *key("orders_enriched", "order_id"), not_null("orders_enriched", "order_total"),
        accepted_values("orders_enriched", "is_late", (0, 1)),
    ]


def mart_tests(now=None) -> list[TableTest]:
    return [
        *key("fct_orders", "order_sk"), *key("fct_orders", "order_id"),
        not_null("fct_orders", "order_total"),
        not_in_future("fct_orders", "order_purchase_ts", now),
        not_in_future("fct_orders", "delivered_at", now),
        *key("dim_customers", "customer_sk"), *key("dim_customers", "customer_unique_id"),
        *key("dim_products", "product_sk"), *key("dim_products", "product_id"),
    ]


def report_tests() -> list[TableTest]:
    percent = {"low": 0, "high": 100}
    return [
        in_range("revenue_by_category", "revenue", low=0),
        not_null("delivery_by_state", "customer_state"),
        not_null("delivery_by_state", "delivered_orders"),
        in_range("delivery_by_state", "on_time_pct", **percent),
        *key("seller_scorecard", "seller_id"),
        in_range("seller_scorecard", "late_pct", **percent),
        *key("customer_cohorts", "cohort_month"),
        in_range("customer_cohorts", "n_customers", low=0),
        in_range("customer_cohorts", "n_repeat_customers", low=0),
        in_range("customer_cohorts", "repeat_customer_pct", **percent),
        in_range("customer_cohorts", "avg_lifetime_value", low=0),
        *key("review_sentiment", "category"),
        in_range("review_sentiment", "n_reviews", low=0),
        in_range("review_sentiment", "avg_review_score", low=1, high=5),
        in_range("review_sentiment", "pct_1_star", **percent),
        in_range("review_sentiment", "pct_5_star", **percent),
        no_negative_revenue(),
    ]


def no_future_orders(now=None) -> TableTest:
    test = not_in_future("orders", "order_purchase_ts", now)
    return returns_no_rows("no order lies in the future",
                           lambda t: t["orders"].filter(test.row_condition))


def no_negative_revenue() -> TableTest:
    return returns_no_rows("no seller has negative revenue",
                           lambda t: t["seller_scorecard"].filter("revenue < 0"))
