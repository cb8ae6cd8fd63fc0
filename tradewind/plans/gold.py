"""Gold reports.

Revenue, delivery and review reports exist at several grains under similar
names; each function says which grain it has and which label a missing
category gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as X
from tradewind.functions.columns import rows

# how the reports of the change track are laid out
CLUSTER_BY = {"monthly_delivery": ["order_month"], "category_totals": ["category"],
              "category_review_scores": ["category"]}


def _delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == "delivered")


def _scores_per_order(reviews: DataFrame) -> DataFrame:
    """Everything the review reports need from an order's reviews, as sums."""
    score = F.col("review_score")
    optional = {"review_id": F.count("review_id").alias("r_ids"),
                "has_comment": F.count_if("has_comment").alias("r_comments")}
    return reviews.groupBy("order_id").agg(
        rows().alias("r_rows"), F.count(score).alias("r_scored"), F.sum(score).alias("r_sum"),
        F.count_if(score == 1).alias("r_ones"), F.count_if(score == 5).alias("r_fives"),
        *[total for name, total in optional.items() if name in reviews.columns])


def _times(n: str, value: str):
    return F.sum(F.col(n) * F.col(value))


# --- model project: built on the star schema --------------------------------

def delivery_by_customer_state(fact: DataFrame, regions: DataFrame) -> DataFrame:
    """State and region grain, delivered orders with a delivery date.

    Per-state sums come first, so the region lookup meets one row per state.
    """
    arrived = _delivered(fact).filter(F.col("delivered_at").isNotNull())
    by_state = arrived.groupBy("customer_state").agg(
        rows().alias("n"), F.sum("days_to_deliver").alias("days"),
        F.sum("is_late").alias("late"))
    n, late = F.col("n"), F.col("late")
    return (by_state.join(regions, by_state["customer_state"] == regions["state"], "left")
            .select("customer_state", "region", n.alias("delivered_orders"),
                    X.ratio(F.col("days"), n, 1).alias("avg_delivery_days"),
                    X.percent(late, n, 1).alias("late_pct"),
                    X.percent(n - late, n, 1).alias("on_time_pct")))


def monthly_revenue_star(items: DataFrame, fact: DataFrame, labels: DataFrame) -> DataFrame:
    """Month and category grain; items of unknown products keep a NULL category."""
    sold = (items.select("order_id", "product_id", "price")
            .join(_delivered(fact).select("order_id", "order_purchase_ts"), "order_id")
            .join(labels.select("product_id", "category"), "product_id", "left"))
    return sold.groupBy("category", X.month_start("order_purchase_ts").alias("order_month")).agg(
        F.countDistinct("order_id").alias("order_count"),
        X.amount(F.sum("price")).alias("revenue"))


def seller_scorecard(items: DataFrame, fact: DataFrame, sellers: DataFrame,
                     order_reviews: DataFrame) -> DataFrame:
    """Seller grain over delivered orders; days, lateness and scores weigh by item."""
    arrived = _delivered(fact).select("order_id", "days_to_deliver", "is_late")
    lines = (items.select("order_id", "seller_id", "price").join(arrived, "order_id")
             .join(order_reviews.select("order_id", "avg_review_score"), "order_id", "left"))
    totals = lines.groupBy("seller_id").agg(
        F.countDistinct("order_id").alias("n_orders"),
        X.amount(F.sum("price")).alias("revenue"),
        X.ratio(F.sum("days_to_deliver"), F.count("days_to_deliver"), 1)
        .alias("avg_delivery_days"),
        X.percent(F.sum("is_late"), F.count("is_late"), 1).alias("late_pct"),
        X.percent(F.sum(1 - F.col("is_late")), F.count("is_late"), 1).alias("on_time_pct"),
        F.round(F.avg("avg_review_score"), 2).alias("avg_review_score"))
    return totals.join(sellers.select("seller_id", "seller_state"), "seller_id")


def customer_cohorts(people: DataFrame) -> DataFrame:
    """First-order month grain; every order status counts."""
    repeat = F.col("is_repeat_customer").cast("int")
    return people.groupBy(X.month_start("first_order_ts").alias("cohort_month")).agg(
        rows().alias("n_customers"),
        F.coalesce(F.sum(repeat), F.lit(0)).alias("n_repeat_customers"),
        X.percent(F.sum(repeat), F.count(repeat), 2).alias("repeat_customer_pct"),
        X.ratio(F.sum("lifetime_value"), F.count("lifetime_value"), 2)
        .alias("avg_lifetime_value"))


def review_sentiment_by_category(items: DataFrame, labels: DataFrame,
                                 reviews: DataFrame) -> DataFrame:
    """Category grain; a review counts once per category of its order."""
    pairs = (items.select("order_id", "product_id")
             .join(labels.select("product_id", "category"), "product_id", "left")
             .select("order_id", "category").distinct())
    scored = F.sum("r_scored")
    return pairs.join(_scores_per_order(reviews), "order_id").groupBy("category").agg(
        scored.alias("n_reviews"),
        X.ratio(F.sum("r_sum"), scored, 2).alias("avg_review_score"),
        X.percent(F.sum("r_ones"), scored, 1).alias("pct_1_star"),
        X.percent(F.sum("r_fives"), scored, 1).alias("pct_5_star"))


# --- append pipeline ---------------------------------------------------------

def monthly_revenue(items: DataFrame, orders: DataFrame, products: DataFrame,
                    translation: DataFrame) -> DataFrame:
    """Month and category grain; only items of known products, category may stay NULL."""
    labels = products.join(translation, "product_category_name", "left").select(
        "product_id",
        F.coalesce("product_category_name_english", "product_category_name").alias("category"))
    sold = (items.select("order_id", "product_id", "price")
            .join(_delivered(orders).select("order_id", "order_purchase_ts"), "order_id")
            .join(labels, "product_id"))
    return sold.groupBy("category", X.month_start("order_purchase_ts").alias("month")).agg(
        X.amount(F.sum("price")).alias("revenue"),
        F.countDistinct("order_id").alias("order_count"))


def delivery_by_seller_state(orders: DataFrame, items: DataFrame,
                             sellers: DataFrame) -> DataFrame:
    """Seller state at item grain; without an estimate an item is neither late nor on time.

    Items are counted per order and seller first, then weigh the order's facts.
    """
    arrived = _delivered(orders).filter(F.col("delivered_at").isNotNull()).select(
        "order_id",
        X.elapsed_days("order_purchase_ts", "delivered_at").alias("days"),
        X.on_time("delivered_at", "estimated_delivery_at").alias("on_time"))
    lines = items.groupBy("order_id", "seller_id").agg(rows().alias("n"))
    weighed = (lines.join(arrived, "order_id")
               .join(sellers.select("seller_id", "seller_state"), "seller_id"))
    n = F.col("n")
    total = F.sum(n)
    return weighed.groupBy("seller_state").agg(
        total.alias("total_orders"),
        X.ratio(F.sum(n * F.col("days")), total, 1).alias("avg_delivery_days"),
        X.percent(F.sum(F.when(~F.col("on_time"), n).otherwise(0)), total, 2).alias("late_pct"),
        X.percent(F.sum(F.when(F.col("on_time"), n).otherwise(0)), total, 2)
        .alias("on_time_pct"))


def seller_review_scores(items: DataFrame, reviews: DataFrame, sellers: DataFrame,
                         at_least: int = 10) -> DataFrame:
    """Seller grain; an order's review repeats for each of its items."""
    scored = reviews.filter(F.col("review_score").isNotNull())
    lines = items.groupBy("order_id", "seller_id").agg(rows().alias("n"))
    per_seller = lines.join(_scores_per_order(scored), "order_id").groupBy("seller_id").agg(
        _times("n", "r_rows").alias("total_reviews"),
        _times("n", "r_sum").alias("score_sum"), _times("n", "r_fives").alias("fives"))
    total = F.col("total_reviews")
    return (per_seller.filter(total >= at_least)
            .join(sellers.select("seller_id", "seller_city", "seller_state"), "seller_id")
            .select("seller_id", "seller_city", "seller_state",
                    X.ratio(F.col("score_sum"), total, 2).alias("avg_review_score"),
                    "total_reviews", X.percent(F.col("fives"), total, 1).alias("pct_5_star")))


# --- change-data pipeline ----------------------------------------------------

def monthly_delivery(orders: DataFrame) -> DataFrame:
    """Month grain over the cleaned orders."""
    def status(name: str):
        return F.col("order_status") == name
    on_time = F.col("is_on_time")
    days = F.when(status("delivered"), F.col("delivery_days"))
    return orders.groupBy(X.month_text("order_purchase_timestamp").alias("order_month")).agg(
        rows().alias("order_count"),
        F.count_if(status("delivered")).alias("delivered_count"),
        F.count_if(status("canceled")).alias("canceled_count"),
        F.round(F.avg(days), 1).alias("avg_delivery_days"),
        X.ratio(F.count_if(on_time), F.count(on_time), 4).alias("on_time_rate"),
        F.count_if(~on_time).alias("late_delivery_count"))


def category_totals(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Category grain, all time, delivered orders; untranslated products share one label."""
    label = X.first_known("product_category_name_english", default="uncategorized")
    sold = (items.select("order_id", "product_id", "price", "freight_value", "total_item_value")
            .join(_delivered(orders).select("order_id"), "order_id")
            .join(products.select("product_id", "product_category_name_english"),
                  "product_id", "left"))
    return sold.groupBy(label.alias("category")).agg(
        X.amount(F.sum("total_item_value")).alias("total_revenue"),
        X.amount(F.sum("price")).alias("total_product_revenue"),
        X.amount(F.sum("freight_value")).alias("total_freight_revenue"),
        F.countDistinct("order_id").alias("order_count"),
        rows().alias("item_count"),
        X.ratio(F.sum("total_item_value"), F.count("total_item_value"), 2)
        .alias("avg_item_value"))


def category_review_scores(reviews: DataFrame, orders: DataFrame, items: DataFrame,
                           products: DataFrame) -> DataFrame:
    """Category grain; a review counts once per distinct product of its order."""
    label = X.first_known("product_category_name_english", default="uncategorized")
    weights = (items.select("order_id", "product_id").distinct()
               .join(products.select("product_id", "product_category_name_english"),
                     "product_id", "left")
               .groupBy("order_id", label.alias("category")).agg(rows().alias("n")))
    known = weights.join(orders.select("order_id"), "order_id")
    scored = known.join(_scores_per_order(reviews), "order_id")
    return scored.groupBy("category").agg(
        _times("n", "r_ids").alias("review_count"),
        X.ratio(_times("n", "r_sum"), _times("n", "r_scored"), 3).alias("avg_score"),
        X.ratio(_times("n", "r_fives"), _times("n", "r_rows"), 4).alias("pct_5_stars"),
        X.ratio(_times("n", "r_ones"), _times("n", "r_rows"), 4).alias("pct_1_stars"),
        _times("n", "r_comments").alias("reviews_with_comment"))
