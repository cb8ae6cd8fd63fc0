"""Physical plans: what reaches the scan, what shuffles, what is broadcast."""

import re

import pytest
from oracle import SF_DIR
from pyspark.sql import functions as F

from tradewind.checks.shapes import Retail
from tradewind.operators import joins, ranking
from tradewind.plans import explore, gold
from tradewind.sources import layout


@pytest.fixture(scope="module")
def t(spark):
    return Retail(spark, SF_DIR)


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def test_filters_and_columns_reach_the_scan(t):
    text = plan(t.raw("orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey"))
    assert "EqualTo(o_orderstatus,F)" in text
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>", text)


def test_status_filter_on_the_shaped_orders_reads_three_columns(t):
    text = plan(explore.orders_by_state(t.orders_placed, t.customers))
    assert "o_totalprice" not in text and "o_orderdate" not in text and "lineitem" not in text


def test_month_partitions_are_pruned(t, tmp_path):
    layout.write_by_month(t.orders_placed, "order_purchase_ts", f"{tmp_path}/m")
    month = t.spark.read.parquet(f"{tmp_path}/m").filter(F.col("purchase_month") == "1998-01")
    assert re.search(r"PartitionFilters: \[isnotnull\(purchase_month", plan(month))


def test_lookup_join_obeys_the_threshold_and_starts_no_job(t):
    before = t.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    tracker = t.spark.sparkContext.statusTracker()
    products, translation = t.products, t.translation  # reading a schema is a job
    t.spark.sparkContext.setJobGroup("lookup", "planning")
    t.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.lookup_join(products, translation, "product_category_name"), "simple")
        seed = plan(joins.fixed_lookup_join(products, translation, "product_category_name"), "simple")
    finally:
        t.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        started = tracker.getJobIdsForGroup("lookup")
        t.spark.sparkContext.setJobGroup("", "")
    assert "SortMergeJoin" in text and "BroadcastHashJoin" in seed and not started


def test_latest_per_key_drops_rows_before_the_shuffle(t):
    text = plan(ranking.latest_per_key(t.order_reviews, ["review_id"],
                                       [F.desc("review_answer_timestamp")]), "simple")
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange hashpartitioning[\s\S]*WindowGroupLimit.*Partial", text)


def test_top_k_needs_no_full_sort(t):
    text = plan(explore.top_products(t.order_items, t.products), "simple")
    assert "TakeOrderedAndProject" in text


def test_no_query_plan_pairs_rows_without_a_key(t):
    for df in (gold.seller_review_scores(t.order_items, t.order_reviews, t.sellers),
               explore.top_customers_by_state(t.orders_placed, t.customers)):
        assert "CartesianProduct" not in plan(df, "simple")
        assert "BroadcastNestedLoopJoin" not in plan(df, "simple")


def test_narrow_steps_do_not_shuffle(t):
    text = plan(t.order_items.filter(F.col("price") > 10).select("order_id"), "simple")
    assert "Exchange" not in text
