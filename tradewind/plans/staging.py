"""Staging: one function per landed table, renaming and typing only.

Landed columns are strings. Casts never fail a job: unreadable text becomes
NULL, and the tests on the staged tables decide whether that is acceptable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as X


def orders(landed: DataFrame) -> DataFrame:
    instants = {
        "order_purchase_ts": "order_purchase_timestamp",
        "approved_at": "order_approved_at",
        "shipped_at": "order_delivered_carrier_date",
        "delivered_at": "order_delivered_customer_date",
        "estimated_delivery_at": "order_estimated_delivery_date",
    }
    return landed.select(
        "order_id", "customer_id", "order_status",
        *[X.as_timestamp(source).alias(name) for name, source in instants.items()])


def order_items(landed: DataFrame) -> DataFrame:
    return landed.select(
        "order_id", X.typed("order_item_id", "int").alias("order_item_id"),
        "product_id", "seller_id",
        X.money("price").alias("price"), X.money("freight_value").alias("freight_value"),
        X.as_timestamp("shipping_limit_date").alias("shipping_limit_ts"))


def order_payments(landed: DataFrame) -> DataFrame:
    return landed.select(
        "order_id", X.typed("payment_sequential", "int").alias("payment_sequential"),
        "payment_type", X.typed("payment_installments", "int").alias("payment_installments"),
        X.typed("payment_value", "double").alias("payment_value"))


def order_reviews(landed: DataFrame) -> DataFrame:
    """Keeps genuine reviews only: text that broke over lines leaves no 1-5 score."""
    genuine = landed.filter(F.col("review_score").rlike("^[1-5]$"))
    return genuine.select(
        "review_id", "order_id", X.typed("review_score", "int").alias("review_score"),
        X.as_timestamp("review_creation_date").alias("review_created_at"),
        X.as_timestamp("review_answer_timestamp").alias("review_answered_at"))


def customers(landed: DataFrame) -> DataFrame:
    return landed.withColumnRenamed("customer_zip_code_prefix", "zip_code").select(
        "customer_id", "customer_unique_id", "zip_code", "customer_city", "customer_state")


def products(landed: DataFrame) -> DataFrame:
    sizes = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    return landed.select("product_id", "product_category_name",
                         *[X.typed(c, "int").alias(c) for c in sizes])


def sellers(landed: DataFrame) -> DataFrame:
    return landed.withColumnRenamed("seller_zip_code_prefix", "zip_code").select(
        "seller_id", "zip_code", "seller_city", "seller_state")


STAGES = {"orders": orders, "order_items": order_items, "order_payments": order_payments,
          "order_reviews": order_reviews, "customers": customers, "products": products,
          "sellers": sellers}
