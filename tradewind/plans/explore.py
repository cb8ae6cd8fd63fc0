"""Questions asked of the order tables.

Inputs carry the staged column names. Where two many-rows-per-order tables
meet, each side is first reduced to counts and sums per order, which gives the
same totals as pairing their rows without ever forming the pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as X
from tradewind.operators import aggregates, joins, ranking


def status_distribution(orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("order_status").agg(X.rows().alias("order_count"))
    return counts.orderBy(F.desc("order_count"), "order_status")


def delivery_time_stats(orders: DataFrame) -> DataFrame:
    days = X.calendar_days("order_purchase_ts", "delivered_at")
    return orders.filter(F.col("delivered_at").isNotNull()).agg(
        F.round(F.avg(days), 1).alias("avg_delivery_days"),
        F.min(days).alias("min_delivery_days"),
        F.max(days).alias("max_delivery_days"))


def category_revenue(items: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    label = X.first_known("product_category_name", default="unknown")
    named = items.join(products.select("product_id", "product_category_name"),
                       "product_id", "left")
    totals = named.groupBy(label.alias("category")).agg(
        X.amount(F.sum("price")).alias("total_revenue"),
        F.countDistinct("order_id").alias("order_count"))
    return ranking.top_n(totals, n, [F.desc("total_revenue"), F.asc("category")])


def review_score_share(reviews: DataFrame) -> DataFrame:
    counts = reviews.groupBy("review_score").agg(X.rows().alias("review_count"))
    return aggregates.share_of_total(counts, "review_count", "pct")


def late_rate_by_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    delivered = orders.filter(F.col("delivered_at").isNotNull()).select(
        "customer_id", X.late_flag("delivered_at", "estimated_delivery_at").alias("late"))
    located = delivered.join(customers.select("customer_id", "customer_state"),
                             "customer_id", "left")
    return located.groupBy("customer_state").agg(
        X.rows().alias("delivered_count"),
        F.sum("late").alias("late_count"),
        X.percent(F.sum("late"), X.rows(), 2).alias("late_pct"))


def favourite_payment_by_state(payments: DataFrame, orders: DataFrame,
                               customers: DataFrame) -> DataFrame:
    per_order = payments.groupBy("order_id", "payment_type").agg(X.rows().alias("n"))
    counts = (per_order.join(orders.select("order_id", "customer_id"), "order_id")
              .join(customers.select("customer_id", "customer_state"), "customer_id")
              .groupBy("customer_state", "payment_type").agg(F.sum("n").alias("payment_count")))
    return ranking.best_per_group(counts, ["customer_state"], "payment_count")


def orders_by_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    located = orders.select("order_id", "customer_id").join(
        customers.select("customer_id", "customer_state"), "customer_id")
    return located.groupBy("customer_state").agg(
        F.countDistinct("order_id").alias("order_count"))


def top_products(items: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    """Items are summed per product before they meet the product table."""
    sold = items.groupBy("product_id").agg(F.sum("price").alias("sold"))
    named = sold.join(products.select("product_id", "product_category_name"),
                      "product_id", "left")
    return ranking.top_n(
        named.select("product_id", "product_category_name",
                     X.amount(F.col("sold")).alias("total_revenue")),
        n, [F.desc("total_revenue"), F.asc("product_id")])


def top_seller_states(items: DataFrame, sellers: DataFrame, n: int = 10) -> DataFrame:
    placed = items.select("seller_id", "order_id", "price").join(
        sellers.select("seller_id", "seller_state"), "seller_id")
    totals = placed.groupBy("seller_state").agg(
        X.amount(F.sum("price")).alias("total_revenue"),
        F.countDistinct("order_id").alias("order_count"))
    return ranking.top_n(totals, n, [F.desc("total_revenue"), F.asc("seller_state")])


def payment_stats(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_type").agg(
        X.rows().alias("payment_count"),
        X.ratio(F.sum("payment_value"), F.count("payment_value"), 2).alias("avg_payment_value"))


def frequent_products(items: DataFrame, more_than: int = 100, n: int = 20) -> DataFrame:
    counts = items.groupBy("product_id").agg(X.rows().alias("item_count"))
    return ranking.top_n(counts, n, [F.desc("item_count"), F.asc("product_id")],
                         at_least=F.col("item_count") > more_than)


def product_review_averages(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every item of an order carries every review of that order."""
    per_order = reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("scored"),
        F.count("review_id").alias("reviews"))
    copies = items.groupBy("order_id", "product_id").agg(X.rows().alias("n"))
    n = F.col("n")
    return copies.join(per_order, "order_id").groupBy("product_id").agg(
        X.ratio(F.sum(n * F.col("score_sum")), F.sum(n * F.col("scored")), 2).alias("avg_score"),
        F.sum(n * F.col("reviews")).alias("review_count"))


def well_reviewed_products(items: DataFrame, reviews: DataFrame, at_least: float = 4.0,
                           n: int = 20) -> DataFrame:
    return ranking.top_n(
        product_review_averages(items, reviews), n,
        [F.desc("avg_score"), F.desc("review_count"), F.asc("product_id")],
        at_least=F.col("avg_score") >= at_least)


def customer_order_counts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    per_account = orders.groupBy("customer_id").agg(X.rows().alias("n"))
    return (per_account.join(
        customers.select("customer_id", "customer_unique_id", "customer_state"), "customer_id")
        .groupBy("customer_unique_id", "customer_state").agg(F.sum("n").alias("order_count")))


def top_customers_by_state(orders: DataFrame, customers: DataFrame) -> DataFrame:
    counts = customer_order_counts(orders, customers)
    return (ranking.best_per_group(counts, ["customer_state"], "order_count")
            .withColumn("state_rank", F.lit(1)))


def items_with_english_category(items: DataFrame, products: DataFrame,
                                translation: DataFrame) -> DataFrame:
    named = items.select("order_id", "product_id", "price").join(
        products.select("product_id", "product_category_name"), "product_id", "left")
    return joins.lookup_join(named, translation, "product_category_name").select(
        "order_id", "product_id", "product_category_name", "product_category_name_english",
        "price")


def populous_states(customers: DataFrame, more_than: int = 500) -> DataFrame:
    counts = customers.groupBy("customer_state").agg(X.rows().alias("customer_count"))
    return counts.filter(F.col("customer_count") > more_than)


def busiest_states(orders: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    return ranking.top_n(orders_by_state(orders, customers), n,
                         [F.desc("order_count"), F.asc("customer_state")])
