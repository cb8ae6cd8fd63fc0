"""The retail tables of the platform, shaped from the given parquet tables.

``Retail`` gives the Spark side lazily, one method per table, so a query scans
only what it names; ``SHAPE_SQL`` states the same tables for the SQL oracle.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


RATE = "decimal(4,2)"  # a product with money still fits a long


def _exact(name: str, kind: str = MONEY) -> Column:
    """Money and rates as decimals: products of doubles round differently by engine."""
    return F.col(name).cast(kind)


class Retail:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))

    @cached_property
    def orders_placed(self) -> DataFrame:
        """Orders without the delivery instant: one narrow scan, no shuffle."""
        status = (F.when(F.col("o_orderstatus") == "F", "delivered")
                  .when(F.col("o_orderstatus") == "O", "shipped").otherwise("canceled"))
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            status.alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_ts"),
            (F.col("o_orderdate") + F.expr("interval 365 days")).alias("estimated_delivery_at"))

    @cached_property
    def orders(self) -> DataFrame:
        """Orders with the first shipping date on or after the purchase.

        Lines meet orders in an inner join, where a hot order can be split, and
        only the per-order minimum is joined back.
        """
        placed = self.raw("orders").select(F.col("o_orderkey").alias("order_id"), "o_orderdate")
        lines = self.raw("lineitem").select(F.col("l_orderkey").alias("order_id"), "l_shipdate")
        delivered = (
            lines.join(placed, "order_id")
            .filter(F.col("l_shipdate") >= F.col("o_orderdate"))
            .groupBy("order_id").agg(F.min("l_shipdate").alias("delivered_at")))
        return self.orders_placed.join(delivered, "order_id", "left").select(
            "order_id", "customer_id", "order_status", "order_purchase_ts",
            "delivered_at", "estimated_delivery_at")

    @cached_property
    def order_items(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_ts"),
            F.col("l_extendedprice").cast(MONEY).alias("price"),
            F.round(_exact("l_extendedprice") * _exact("l_tax", RATE), 2).cast(MONEY)
            .alias("freight_value"))

    @cached_property
    def order_payments(self) -> DataFrame:
        kind = (F.when(F.col("l_returnflag") == "A", "credit_card")
                .when(F.col("l_returnflag") == "R", "boleto").otherwise("voucher"))
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            kind.alias("payment_type"),
            F.col("l_linenumber").alias("payment_installments"),
            F.round(_exact("l_extendedprice") * (1 - _exact("l_discount", RATE)), 2).cast(MONEY)
            .alias("payment_value"))

    @cached_property
    def order_reviews(self) -> DataFrame:
        return self.raw("events").select(
            (F.col("event_id") % 9500).alias("review_id"),
            F.col("event_id").alias("order_id"),
            (1 + F.col("event_id") % 5).cast("int").alias("review_score"),
            F.col("event_type").alias("review_comment_message"),
            F.col("ts").alias("review_answer_timestamp"))

    @cached_property
    def customers(self) -> DataFrame:
        nation = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return self.raw("customer").join(nation, "c_nationkey").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("customer_unique_id"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"))

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.when(F.col("p_partkey") % 97 != 0, F.col("p_type")).alias("product_category_name"),
            F.col("p_size").alias("product_weight_g"))

    @cached_property
    def translation(self) -> DataFrame:
        return (self.raw("part").filter(F.col("p_type") != "PROMO").select("p_type").distinct()
                .select(F.col("p_type").alias("product_category_name"),
                        F.lower("p_type").alias("product_category_name_english")))

    @cached_property
    def sellers(self) -> DataFrame:
        nation = self.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return self.raw("supplier").join(nation, "s_nationkey").select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_name").alias("seller_city"),
            F.col("n_name").alias("seller_state"))

    @cached_property
    def regions(self) -> DataFrame:
        region = self.raw("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
        return self.raw("nation").join(region, "n_regionkey").select(
            F.col("n_name").alias("state"), F.col("r_name").alias("region"))

    @cached_property
    def changes(self) -> DataFrame:
        """Change events: one user per key, errors carry no value."""
        return self.raw("events").select(
            "user_id", "ts", "event_type",
            F.when(F.col("event_type") != "error", F.col("value")).alias("value"))

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in (
            "orders", "order_items", "order_payments", "order_reviews", "customers",
            "products", "translation", "sellers", "regions")}

    # --- the landing layer: the same rows, every column a string ------------

    def _as_text(self, df: DataFrame, **columns) -> DataFrame:
        return df.select(*[c.cast("string").alias(name) for name, c in columns.items()])

    @cached_property
    def landed_orders(self) -> DataFrame:
        c = F.col
        return self._as_text(
            self.orders, order_id=c("order_id"), customer_id=c("customer_id"),
            order_status=c("order_status"), order_purchase_timestamp=c("order_purchase_ts"),
            order_approved_at=c("order_purchase_ts"),
            order_delivered_carrier_date=c("delivered_at"),
            order_delivered_customer_date=c("delivered_at"),
            order_estimated_delivery_date=c("estimated_delivery_at"))

    @cached_property
    def landed_order_items(self) -> DataFrame:
        c = F.col
        return self._as_text(
            self.order_items, order_id=c("order_id"), order_item_id=c("order_item_id"),
            product_id=c("product_id"), seller_id=c("seller_id"),
            shipping_limit_date=c("shipping_limit_ts"), price=c("price"),
            freight_value=c("freight_value"))

    @cached_property
    def landed_order_payments(self) -> DataFrame:
        return self._as_text(self.order_payments,
                             **{n: F.col(n) for n in self.order_payments.columns})

    @cached_property
    def landed_order_reviews(self) -> DataFrame:
        """Reviews in which every eleventh score is unreadable, as in broken rows."""
        c = F.col
        score = F.when(c("order_id") % 11 == 0, F.lit("n/a")).otherwise(
            c("review_score").cast("string"))
        return self._as_text(
            self.order_reviews, review_id=c("review_id"), order_id=c("order_id"),
            review_score=score,
            review_comment_title=F.concat(F.lit(" "), c("review_comment_message")),
            review_comment_message=F.when(c("review_score") > 1, F.concat(
                F.lit("  "), c("review_comment_message"), F.lit(" "))).otherwise(F.lit(" ")),
            review_creation_date=c("review_answer_timestamp"),
            review_answer_timestamp=c("review_answer_timestamp"))

    @cached_property
    def landed_customers(self) -> DataFrame:
        c = F.col
        return self._as_text(
            self.customers, customer_id=c("customer_id"),
            customer_unique_id=c("customer_unique_id"),
            customer_zip_code_prefix=c("customer_id") % 1000,
            customer_city=F.concat(F.lit(" "), F.lower("customer_city")),
            customer_state=F.concat(F.lower("customer_state"), F.lit(" ")))

    @cached_property
    def landed_products(self) -> DataFrame:
        c = F.col
        return self._as_text(
            self.products, product_id=c("product_id"),
            product_category_name=c("product_category_name"),
            product_name_lenght=c("product_weight_g") + 1,
            product_description_lenght=c("product_weight_g") + 2,
            product_photos_qty=c("product_weight_g") % 5,
            product_weight_g=c("product_weight_g"),
            product_length_cm=c("product_weight_g") + 3,
            product_height_cm=c("product_weight_g") + 4,
            product_width_cm=c("product_weight_g") + 5)

    @cached_property
    def landed_sellers(self) -> DataFrame:
        c = F.col
        return self._as_text(
            self.sellers, seller_id=c("seller_id"), seller_zip_code_prefix=c("seller_id") % 100,
            seller_city=F.concat(F.lit(" "), F.lower("seller_city")),
            seller_state=F.concat(F.lower("seller_state"), F.lit(" ")))


SHAPE_SQL = {
    "s_orders": """
        select o.o_orderkey as order_id, o.o_custkey as customer_id,
               case o.o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped'
                    else 'canceled' end as order_status,
               o.o_orderdate as order_purchase_ts,
               min(case when l.l_shipdate >= o.o_orderdate then l.l_shipdate end) as delivered_at,
               o.o_orderdate + interval '365' day as estimated_delivery_at
        from orders o left join lineitem l on l.l_orderkey = o.o_orderkey
        group by o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate""",
    "s_order_items": """
        select l_orderkey as order_id, l_linenumber as order_item_id, l_partkey as product_id,
               l_suppkey as seller_id, l_shipdate as shipping_limit_ts,
               cast(l_extendedprice as decimal(12,2)) as price,
               cast(round(cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)), 2)
                    as decimal(12,2)) as freight_value
        from lineitem""",
    "s_customers": """
        select c_custkey as customer_id, c_custkey as customer_unique_id,
               c_mktsegment as customer_city, n_name as customer_state
        from customer join nation on c_nationkey = n_nationkey""",
    "s_products": """
        select p_partkey as product_id,
               case when p_partkey % 97 = 0 then null else p_type end as product_category_name,
               p_size as product_weight_g
        from part""",
    "s_translation": """
        select distinct p_type as product_category_name,
               lower(p_type) as product_category_name_english
        from part where p_type <> 'PROMO'""",
    "s_sellers": """
        select s_suppkey as seller_id, s_name as seller_city, n_name as seller_state
        from supplier join nation on s_nationkey = n_nationkey""",
    "s_order_payments": """
        select l_orderkey as order_id, l_linenumber as payment_sequential,
               case l_returnflag when 'A' then 'credit_card' when 'R' then 'boleto'
                    else 'voucher' end as payment_type,
               l_linenumber as payment_installments,
               cast(round(cast(l_extendedprice as decimal(12,2))
                          * (1 - cast(l_discount as decimal(4,2))), 2) as decimal(12,2))
                   as payment_value
        from lineitem""",
    "s_order_reviews": """
        select event_id % 9500 as review_id, event_id as order_id,
               cast(1 + event_id % 5 as int) as review_score,
               event_type as review_comment_message, ts as review_answer_timestamp
        from events""",
    "s_regions": """
        select n_name as state, r_name as region
        from nation join region on n_regionkey = r_regionkey""",
    "s_changes": """
        select user_id, ts, event_type,
               case when event_type <> 'error' then value end as value
        from events""",
}
