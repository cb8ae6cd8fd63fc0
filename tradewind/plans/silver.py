"""Silver tables: cleaning functions and their row rules.

Two tracks share the landed tables. The append track types the rows and keeps
every row that passes. The change track prepares rows for a keyed change apply.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as X
from tradewind.functions.domains import ORDER_STATUSES, STATES
from tradewind.operators.quality import DROP, FAIL, WARN, Rule

INGESTED = "_ingestion_timestamp"
SOURCE = "_source_file"


def _set(c: str) -> Column:
    return F.col(c).isNotNull()


# --- append track ------------------------------------------------------------

def orders_typed(landed: DataFrame) -> DataFrame:
    names = {"order_purchase_ts": "order_purchase_timestamp", "approved_at": "order_approved_at",
             "estimated_delivery_ts": "order_estimated_delivery_date",
             "delivered_at": "order_delivered_customer_date"}
    return landed.select("order_id", "customer_id", "order_status",
                         *[X.as_timestamp(c).alias(n) for n, c in names.items()])


def order_items_typed(landed: DataFrame) -> DataFrame:
    price, freight = X.typed("price", "double"), X.typed("freight_value", "double")
    return landed.select("order_id", "order_item_id", "product_id", "seller_id",
                         price.alias("price"), freight.alias("freight_value"),
                         (price + freight).alias("price_with_freight"))


def products_typed(landed: DataFrame) -> DataFrame:
    return landed


def sellers_typed(landed: DataFrame) -> DataFrame:
    return landed.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def order_reviews_typed(landed: DataFrame) -> DataFrame:
    return landed.select("order_id", X.typed("review_score", "int").alias("review_score"),
                         X.as_timestamp("review_creation_date").alias("review_ts"))


def append_rules() -> dict[str, list[Rule]]:
    return {
        "orders": [Rule("valid_order_id", _set("order_id"), DROP),
                   Rule("valid_order_status", _set("order_status"), WARN)],
        "order_items": [Rule("valid_order_id", _set("order_id"), DROP)],
        "products": [],
        "sellers": [Rule("valid_seller_id", _set("seller_id"), DROP)],
        "order_reviews": [Rule("valid_score", F.col("review_score").between(1, 5), WARN)],
    }


APPEND_TRACK = {"orders": orders_typed, "order_items": order_items_typed,
                "products": products_typed, "sellers": sellers_typed,
                "order_reviews": order_reviews_typed}


# --- change track ------------------------------------------------------------

def _provenance(landed: DataFrame) -> list[str]:
    return [c for c in (SOURCE, INGESTED) if c in landed.columns]


def customers_staged(landed: DataFrame) -> DataFrame:
    return landed.select(
        "customer_id", "customer_unique_id",
        F.col("customer_zip_code_prefix").cast("string").alias("customer_zip_code_prefix"),
        X.place_name("customer_city").alias("customer_city"),
        X.place_name("customer_state").alias("customer_state"), *_provenance(landed))


def order_items_staged(landed: DataFrame) -> DataFrame:
    price, freight = X.typed("price", "double"), X.typed("freight_value", "double")
    return landed.select(
        "order_id", X.typed("order_item_id", "int").alias("order_item_id"),
        "product_id", "seller_id",
        X.as_timestamp("shipping_limit_date").alias("shipping_limit_date"),
        price.alias("price"), freight.alias("freight_value"),
        (price + freight).alias("total_item_value"), *_provenance(landed))


def orders_staged(landed: DataFrame) -> DataFrame:
    instants = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                "order_delivered_customer_date", "order_estimated_delivery_date"]
    dates = [c for c in ("year", "month", "day") if c in landed.columns]
    typed = landed.select("order_id", "customer_id", "order_status",
                          *[X.as_timestamp(c).alias(c) for c in instants],
                          *dates, *_provenance(landed))
    return typed.withColumns({
        "delivery_days": X.calendar_days("order_purchase_timestamp",
                                         "order_delivered_customer_date"),
        "is_on_time": X.on_time("order_delivered_customer_date",
                                "order_estimated_delivery_date")})


def products_staged(landed: DataFrame, translation: DataFrame) -> DataFrame:
    """Works on batches and on streams: the translation side is always a plain table."""
    counts = {"product_name_length": "product_name_lenght",
              "product_description_length": "product_description_lenght",
              "product_photos_qty": "product_photos_qty"}
    sizes = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
    english = translation.select("product_category_name", "product_category_name_english")
    return landed.join(english, "product_category_name", "left").select(
        "product_id", "product_category_name", "product_category_name_english",
        *[X.typed(c, "int").alias(n) for n, c in counts.items()],
        *[X.typed(c, "double").alias(c) for c in sizes], *_provenance(landed))


def reviews_staged(landed: DataFrame) -> DataFrame:
    return landed.select(
        "review_id", "order_id", X.typed("review_score", "int").alias("review_score"),
        F.trim("review_comment_title").alias("review_comment_title"),
        F.trim("review_comment_message").alias("review_comment_message"),
        X.as_timestamp("review_creation_date").alias("review_creation_date"),
        X.as_timestamp("review_answer_timestamp").alias("review_answer_timestamp"),
        X.has_text("review_comment_message").alias("has_comment"), *_provenance(landed))


def sellers_staged(landed: DataFrame) -> DataFrame:
    return landed.select(
        "seller_id", F.col("seller_zip_code_prefix").cast("string")
        .alias("seller_zip_code_prefix"),
        X.place_name("seller_city").alias("seller_city"),
        X.place_name("seller_state").alias("seller_state"), *_provenance(landed))


@dataclass(frozen=True)
class ChangeTable:
    """How one silver table follows its bronze table."""

    keys: list[str]
    rules: list[Rule]
    cluster_by: list[str]
    sequence_by: str = INGESTED
    track_except: list[str] = field(default_factory=list)


def change_tables() -> dict[str, ChangeTable]:
    order_rules = [Rule("order_id_not_null", _set("order_id"), FAIL),
                   Rule("customer_id_not_null", _set("customer_id"), DROP),
                   Rule("valid_order_status", F.col("order_status").isin(*ORDER_STATUSES), WARN)]
    return {
        "customers": ChangeTable(["customer_id"], [
            Rule("customer_id_not_null", _set("customer_id"), FAIL),
            Rule("customer_unique_id_not_null", _set("customer_unique_id"), DROP),
            Rule("valid_state", F.upper("customer_state").isin(*STATES), WARN),
        ], ["customer_state", "customer_city"]),
        "order_items": ChangeTable(["order_id", "order_item_id"], [
            Rule("order_id_not_null", _set("order_id"), FAIL),
            Rule("product_id_not_null", _set("product_id"), DROP),
            Rule("seller_id_not_null", _set("seller_id"), DROP),
            Rule("valid_price", F.col("price") > 0, DROP),
            Rule("valid_freight", F.col("freight_value") >= 0, WARN),
        ], ["order_id", "product_id", "seller_id"]),
        "orders": ChangeTable(["order_id"], order_rules,
                              ["order_status", "order_purchase_timestamp"]),
        "products": ChangeTable(["product_id"], [
            Rule("product_id_not_null", _set("product_id"), FAIL),
            Rule("category_not_null", _set("product_category_name"), WARN),
            Rule("valid_weight", F.col("product_weight_g").isNull()
                 | (F.col("product_weight_g") > 0), WARN),
        ], ["product_category_name_english"]),
        "reviews": ChangeTable(["review_id"], [
            Rule("review_id_not_null", _set("review_id"), FAIL),
            Rule("order_id_not_null", _set("order_id"), DROP),
            Rule("valid_score", F.col("review_score").between(1, 5), DROP),
        ], ["order_id", "review_score"]),
        "sellers": ChangeTable(["seller_id"], [
            Rule("seller_id_not_null", _set("seller_id"), FAIL),
            Rule("valid_state", F.upper("seller_state").isin(*STATES), WARN),
        ], ["seller_state", "seller_city"]),
        # the dated files: sequenced by the business time of the order
        "dated_orders": ChangeTable(
            ["order_id"], order_rules, ["order_id", "__START_AT"],
            sequence_by="order_purchase_timestamp",
            track_except=[SOURCE, INGESTED, "delivery_days", "is_on_time",
                          "year", "month", "day"]),
    }
