"""Intermediate rollups and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as X
from tradewind.operators import joins


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        X.amount(F.sum("payment_value")).alias("total_paid"),
        X.rows().alias("n_payment_rows"),
        F.max("payment_installments").alias("max_installments"))


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(
        X.rows().alias("item_count"),
        F.sum("price").alias("items_total"),
        F.sum("freight_value").alias("freight_total"))


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        X.ratio(F.sum("review_score"), F.count("review_score"), 2).alias("avg_review_score"),
        X.rows().alias("n_reviews"))


def orders_enriched(orders: DataFrame, customers: DataFrame, items: DataFrame,
                    payments: DataFrame) -> DataFrame:
    """One row per order. Orders without items total 0; without payments they stay NULL.

    All three per-order inputs share the order key, so the orders move once for
    that key and once for the customer key.
    """
    place = customers.select("customer_id", "customer_unique_id", "customer_state",
                             "customer_city")
    joined = (orders.join(items_per_order(items), "order_id", "left")
              .join(payments_per_order(payments), "order_id", "left")
              .join(place, "customer_id", "left"))
    zero = F.lit(0).cast("decimal(22,2)")
    items_total = F.coalesce("items_total", zero)
    freight_total = F.coalesce("freight_total", zero)
    return joined.select(
        "order_id", "customer_id", "customer_unique_id", "customer_state", "customer_city",
        "order_status", "order_purchase_ts", "delivered_at", "estimated_delivery_at",
        F.coalesce("item_count", F.lit(0)).alias("item_count"),
        items_total.alias("items_total"), freight_total.alias("freight_total"),
        (items_total + freight_total).alias("order_total"),
        "total_paid", "max_installments",
        X.calendar_days("order_purchase_ts", "delivered_at").alias("days_to_deliver"),
        X.late_flag("delivered_at", "estimated_delivery_at").alias("is_late"))


def fact_orders(enriched: DataFrame) -> DataFrame:
    key = X.surrogate_key("order_id").alias("order_sk")
    return enriched.select(key, *enriched.columns)


def dim_customers(enriched: DataFrame) -> DataFrame:
    """One row per person, placed where the most recent order came from.

    The place is an aggregate too (latest order first, then names in order), so
    the orders are read and shuffled once.
    """
    bought = F.col("order_purchase_ts")
    latest_first = F.struct(bought.isNull(), -F.unix_micros(bought.cast("timestamp")),
                            F.col("customer_state"), F.col("customer_city"))
    people = enriched.groupBy("customer_unique_id").agg(
        X.rows().alias("n_orders"),
        F.sum("order_total").alias("lifetime_value"),
        F.min(bought).alias("first_order_ts"),
        F.max(bought).alias("last_order_ts"),
        F.min_by(F.struct("customer_state", "customer_city"), latest_first).alias("place"))
    return people.select(
        X.surrogate_key("customer_unique_id").alias("customer_sk"), "customer_unique_id",
        "place.customer_state", "place.customer_city", "n_orders", "lifetime_value",
        "first_order_ts", "last_order_ts", (F.col("n_orders") > 1).alias("is_repeat_customer"))


def product_labels(products: DataFrame, translation: DataFrame) -> DataFrame:
    """product_id with its English label, the untranslated name, or 'unknown'."""
    translated = joins.lookup_join(products, translation, "product_category_name")
    label = X.first_known("product_category_name_english", "product_category_name",
                          default="unknown")
    return translated.withColumn("category", label)


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    labelled = product_labels(products, translation)
    sizes = [c for c in ("product_weight_g", "product_length_cm", "product_height_cm",
                         "product_width_cm") if c in labelled.columns]
    return labelled.select(
        X.surrogate_key("product_id").alias("product_sk"), "product_id", "category",
        F.col("product_category_name").alias("category_pt"), *sizes)
