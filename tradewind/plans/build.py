"""Whole builds: the gated star schema, and the layered change pipeline."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tradewind.operators.quality import require_passing
from tradewind.plans import gold, model_tests, silver, staging, star
from tradewind.sources import growing, layout
from tradewind.streaming import flows, ingest

FACT_KEY, FACT_CURSOR = ["order_id"], "order_purchase_ts"


def stage_landed(landed: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Staged views over the landed tables; lookups pass through."""
    return {name: staging.STAGES[name](df) if name in staging.STAGES else df
            for name, df in landed.items()}


def build_star(spark: SparkSession, staged: Mapping[str, DataFrame], out_dir: str,
               now=None, test: bool = True, full_refresh: bool = False) -> dict[str, DataFrame]:
    """Builds layer by layer; a failed test of severity error stops before the next layer.

    The sources are tested first, their freshness among other things.

    Staging stays views: the gates read each of them several times, so sources
    that are costly to derive should be stored. What several later tables read is stored once. The fact
    table is a versioned table that takes only newer orders after its first build.
    """
    passed = set()

    def gate(tests) -> None:
        """Tests that passed at an earlier gate are not run again: no table changes between gates."""
        if test:
            new = [t for t in tests if (t.name, t.severity) not in passed]
            require_passing(tables, new)
            passed.update((t.name, t.severity) for t in new)

    def store(layer: str, name: str, df: DataFrame) -> None:
        path = os.path.join(out_dir, layer, name)
        df.write.mode("overwrite").parquet(path)
        tables[name] = spark.read.parquet(path)

    tables = dict(staged)
    gate(model_tests.source_tests(now))
    gate(model_tests.staging_tests())

    tables["payments_per_order"] = star.payments_per_order(staged["order_payments"])
    tables["reviews_per_order"] = star.reviews_per_order(staged["order_reviews"])
    store("intermediate", "orders_enriched", star.orders_enriched(
        staged["orders"], staged["customers"], staged["order_items"], staged["order_payments"]))
    gate(model_tests.intermediate_tests())

    tables["fct_orders"] = growing.grow_by_month(
        spark, star.fact_orders(tables["orders_enriched"]), os.path.join(out_dir, "marts", "fct_orders"),
        FACT_KEY, FACT_CURSOR, full_refresh)
    store("marts", "dim_customers", star.dim_customers(tables["orders_enriched"]))
    store("marts", "dim_products", star.dim_products(staged["products"], staged["translation"]))
    gate(model_tests.mart_tests(now))

    fact, labels = tables["fct_orders"], tables["dim_products"]
    items = staged["order_items"]
    for name, df in {
        "delivery_by_state": gold.delivery_by_customer_state(fact, staged["regions"]),
        "revenue_by_category": gold.monthly_revenue_star(items, fact, labels),
        "seller_scorecard": gold.seller_scorecard(items, fact, staged["sellers"],
                                                  tables["reviews_per_order"]),
        "customer_cohorts": gold.customer_cohorts(tables["dim_customers"]),
        "review_sentiment": gold.review_sentiment_by_category(
            items, labels, staged["order_reviews"]),
    }.items():
        store("gold", name, df)
    gate(model_tests.report_tests())
    return tables


def take_snapshot(spark: SparkSession, landed_orders: DataFrame, path: str, run_ts) -> DataFrame:
    """Adds today's order statuses to the history of statuses."""
    source = landed_orders.select("order_id", "order_status", "order_purchase_timestamp")
    return growing.grow_snapshot(spark, source, path, ["order_id"], ["order_status"], run_ts)


# --- the change pipeline -------------------------------------------------------

STAGED = {"customers": silver.customers_staged, "order_items": silver.order_items_staged,
          "orders": silver.orders_staged, "reviews": silver.reviews_staged,
          "sellers": silver.sellers_staged}


def run_change_layers(spark: SparkSession, sources: Mapping[str, tuple[str, str, str | None]],
                      out_dir: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """New files to bronze, bronze changes to silver, silver to gold.

    ``sources`` maps a table to (folder, format, file glob); translation is a
    bronze-only lookup. Running again takes in whatever arrived since.
    """
    def path(*parts: str) -> str:
        return os.path.join(out_dir, *parts)

    for name, (folder, fmt, glob) in sources.items():
        ingest.ingest_files(spark, folder, fmt, path("bronze", name),
                            path("checkpoints", f"bronze_{name}"), glob,
                            multiline=name == "reviews")
    translation = spark.read.option("mergeSchema", True).parquet(path("bronze", "translation"))
    stages = {**STAGED, "products": lambda df: silver.products_staged(df, translation)}
    specs = silver.change_tables()
    tables = {}
    for name in (n for n in sources if n in stages):
        flows.change_flow(spark, path("bronze", name), stages[name], specs[name],
                          path("silver", name), path("checkpoints", f"silver_{name}"),
                          buckets=buckets)
        tables[name] = flows.read_type1(spark, path("silver", name), specs[name].keys)
    reports = {
        "monthly_delivery": gold.monthly_delivery(tables["orders"]),
        "category_totals": gold.category_totals(
            tables["order_items"], tables["orders"], tables["products"]),
        "category_review_scores": gold.category_review_scores(
            tables["reviews"], tables["orders"], tables["order_items"], tables["products"]),
    }
    for name, df in reports.items():
        layout.write_clustered(df, path("gold", name), gold.CLUSTER_BY[name])
        tables[name] = spark.read.parquet(path("gold", name))
    return tables
