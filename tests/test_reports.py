"""Grain traps on hand-written rows: several reviews, items and places per order."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tradewind.functions import columns as X
from tradewind.operators import aggregates, joins, ranking
from tradewind.plans import build, explore, gold, model_tests, star

D = Decimal
DAY = lambda n: datetime(2018, 1, n, 12)


@pytest.fixture(scope="module")
def shop(spark):
    def df(rows, schema):
        return spark.createDataFrame(rows, schema)
    t = {
        "orders": df([(1, 10, "delivered", DAY(1), DAY(5), DAY(9)), (2, 11, "delivered", DAY(2), DAY(9), DAY(5)),
                      (3, 12, "canceled", DAY(3), None, DAY(9)), (4, 12, "delivered", DAY(4), DAY(6), None)],
                     "order_id int, customer_id int, order_status string, order_purchase_ts timestamp, "
                     "delivered_at timestamp, estimated_delivery_at timestamp"),
        "order_items": df([(1, 1, 100, 7, D("10.00"), D("1.00")), (1, 2, 100, 7, D("10.00"), D("1.00")),
                           (1, 3, 101, 8, D("5.00"), D("0.50")), (2, 1, 102, 7, D("20.00"), D("2.00")),
                           (4, 1, 100, 8, D("7.00"), D("0.00"))],
                          "order_id int, order_item_id int, product_id int, seller_id int, "
                          "price decimal(10,2), freight_value decimal(10,2)"),
        "order_payments": df([(1, 1, "credit_card", 3, 20.0), (1, 2, "voucher", 1, 7.5), (2, 1, "boleto", 1, 22.0),
                              (4, 1, "boleto", 1, 7.0)],
                             "order_id int, payment_sequential int, payment_type string, "
                             "payment_installments int, payment_value double"),
        "order_reviews": df([("a", 1, 5), ("b", 1, 2), ("c", 2, 1), ("d", 4, None)],
                            "review_id string, order_id int, review_score int"),
        "customers": df([(10, "p", "SP", "x"), (11, "p", "RJ", "y"), (12, "q", "SP", "x")],
                        "customer_id int, customer_unique_id string, customer_state string, customer_city string"),
        "products": df([(100, "brinquedos"), (101, "brinquedos"), (102, None)],
                       "product_id int, product_category_name string"),
        "translation": df([("brinquedos", "toys")],
                          "product_category_name string, product_category_name_english string"),
        "sellers": df([(7, "c7", "SP"), (8, "c8", "RJ")], "seller_id int, seller_city string, seller_state string"),
        "regions": df([("SP", "Sudeste")], "state string, region string"),
    }
    t["enriched"] = star.orders_enriched(t["orders"], t["customers"], t["order_items"], t["order_payments"])
    t["labels"] = star.product_labels(t["products"], t["translation"])
    return t


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_enriched_keeps_orders_without_items_or_payments(shop):
    got = {r.order_id: r for r in shop["enriched"].collect()}
    assert (got[3].item_count, got[3].order_total, got[3].total_paid, got[3].is_late) == (0, D("0.00"), None, 0)
    assert (got[1].item_count, got[1].order_total, got[1].total_paid, got[1].max_installments) == (3, D("27.50"), 27.5, 3)
    assert (got[2].days_to_deliver, got[2].is_late, got[4].is_late) == (7, 1, 0)


def test_reviews_weigh_by_item_by_product_and_by_category(shop):
    items, reviews, orders = shop["order_items"], shop["order_reviews"], shop["orders"]
    by_seller = gold.seller_review_scores(items, reviews, shop["sellers"], at_least=1)
    # seller 7 has two items in order 1 (scores 5 and 2) and one in order 2 (score 1)
    assert as_set(by_seller, "seller_id", "avg_review_score", "total_reviews", "pct_5_star") == {
        (7, 3.0, 5, 40.0), (8, 3.5, 2, 50.0)}
    comments = reviews.withColumn("has_comment", F.col("review_id") == "a")
    by_product = gold.category_review_scores(comments, orders, items, shop["labels"])
    # order 1 holds two toys; order 4 has one review without a score
    assert as_set(by_product, "category", "review_count", "avg_score", "pct_5_stars", "reviews_with_comment") == {
        ("toys", 5, 3.5, 0.4, 2), ("uncategorized", 1, 1.0, 0.0, 0)}
    by_category = gold.review_sentiment_by_category(items, shop["labels"], reviews)
    assert as_set(by_category, "category", "n_reviews", "avg_review_score", "pct_5_star") == {
        ("toys", 2, 3.5, 50.0), ("unknown", 1, 1.0, 0.0)}
    averages = explore.product_review_averages(items, reviews)
    assert as_set(averages, "product_id", "avg_score", "review_count") == {
        (100, 3.5, 5), (101, 3.5, 2), (102, 1.0, 1)}


def test_people_span_accounts_and_live_where_they_last_ordered(shop):
    people = {r.customer_unique_id: r for r in star.dim_customers(shop["enriched"]).collect()}
    assert (people["p"].n_orders, people["p"].customer_state, people["p"].lifetime_value) == (2, "RJ", D("49.50"))
    assert people["q"].is_repeat_customer and people["q"].first_order_ts == DAY(3)
    assert as_set(explore.top_customers_by_state(shop["orders"], shop["customers"]),
                  "customer_unique_id", "customer_state", "order_count") == {("q", "SP", 2), ("p", "RJ", 1)}


def test_equal_purchase_times_choose_the_first_place_by_name(spark):
    rows = [(i, "u", s, c, DAY(1), D("1.00")) for i, (s, c) in enumerate([("SP", "b"), ("RJ", "z"), ("RJ", "a")])]
    enriched = spark.createDataFrame(rows, "order_id int, customer_unique_id string, customer_state string, "
                                           "customer_city string, order_purchase_ts timestamp, order_total decimal(10,2)")
    only = star.dim_customers(enriched).first()
    assert (only.customer_state, only.customer_city, only.n_orders) == ("RJ", "a", 3)


def test_delivery_reports_differ_in_grain_and_in_missing_estimates(shop):
    by_seller = gold.delivery_by_seller_state(shop["orders"], shop["order_items"], shop["sellers"])
    assert as_set(by_seller, "seller_state", "total_orders", "late_pct", "on_time_pct") == {
        ("SP", 3, 33.33, 66.67), ("RJ", 2, 0.0, 50.0)}
    by_state = gold.delivery_by_customer_state(star.fact_orders(shop["enriched"]), shop["regions"])
    assert as_set(by_state, "customer_state", "region", "delivered_orders", "on_time_pct") == {
        ("SP", "Sudeste", 2, 100.0), ("RJ", None, 1, 0.0)}


def test_scorecard_weighs_days_by_item(shop):
    card = gold.seller_scorecard(shop["order_items"], star.fact_orders(shop["enriched"]), shop["sellers"],
                                 star.reviews_per_order(shop["order_reviews"]))
    assert as_set(card, "seller_id", "n_orders", "revenue", "avg_delivery_days", "late_pct", "avg_review_score") == {
        (7, 2, 40.0, 5.0, 33.3, 2.67), (8, 2, 12.0, 3.0, 0.0, 3.5)}


def test_category_labels_of_the_three_revenue_reports(shop):
    items = shop["order_items"].withColumn("total_item_value", F.col("price") + F.col("freight_value"))
    assert as_set(gold.monthly_revenue(items, shop["orders"], shop["products"], shop["translation"]),
                  "category", "revenue", "order_count") == {("toys", 32.0, 2), (None, 20.0, 1)}
    assert as_set(gold.category_totals(items, shop["orders"], shop["labels"]), "category", "total_revenue",
                  "item_count") == {("toys", 34.5, 4), ("uncategorized", 22.0, 1)}
    assert as_set(gold.monthly_revenue_star(items, shop["enriched"], shop["labels"]), "category", "revenue") == {
        ("toys", 32.0), ("unknown", 20.0)}


def test_reports_on_empty_input(shop):
    none = {k: df.limit(0) for k, df in shop.items()}
    assert gold.customer_cohorts(star.dim_customers(none["enriched"])).count() == 0
    assert gold.seller_review_scores(none["order_items"], none["order_reviews"], none["sellers"]).count() == 0
    assert explore.delivery_time_stats(none["orders"]).first()[0] is None
    assert explore.review_score_share(none["order_reviews"]).count() == 0


def test_star_build_is_gated_and_fact_grows(spark, shop, tmp_path):
    scored = {**shop, "order_reviews": shop["order_reviews"].dropna()}
    built = build.build_star(spark, scored, str(tmp_path))
    assert built["fct_orders"].count() == 4 and built["customer_cohorts"].count() == 1
    newer = spark.createDataFrame([(5, 10, "delivered", DAY(8), None, None)], shop["orders"].schema)
    late = spark.createDataFrame([(6, 10, "delivered", DAY(1), None, None)], shop["orders"].schema)
    more = {**scored, "orders": shop["orders"].unionByName(newer).unionByName(late)}
    again = build.build_star(spark, more, str(tmp_path))
    assert {r.order_id for r in again["fct_orders"].collect()} == {1, 2, 3, 4, 5}
    broken = {**scored, "orders": shop["orders"].withColumn("order_status", F.lit("lost"))}
    with pytest.raises(Exception, match="order_status accepted_values"):
        build.build_star(spark, broken, str(tmp_path / "broken"))
    assert not (tmp_path / "broken" / "intermediate").exists()


def test_no_gate_repeats_a_test(spark, shop, tmp_path, monkeypatch):
    gates = []
    monkeypatch.setattr(build, "require_passing", lambda tables, tests: gates.append([(t.name, t.severity) for t in tests]))
    build.build_star(spark, shop, str(tmp_path))
    run, every = sum(gates, []), [model_tests.source_tests(), model_tests.staging_tests(), model_tests.intermediate_tests(),
                                  model_tests.mart_tests(), model_tests.report_tests()]
    assert len(gates) == 5 and len(run) == len(set(run))
    assert set(run) == {(t.name, t.severity) for tests in every for t in tests}
    assert {("order_reviews.review_id not_null", s) for s in ("warn", "error")} <= set(run)


def test_layers_read_stored_sources(spark, monkeypatch):
    class Seen(Exception):
        pass

    def build_star(spark, sources, path):
        raise Seen(sources)

    monkeypatch.setattr(build, "build_star", build_star)
    with pytest.raises(Seen) as seen:
        __spark_entry__.queries()["a19_layers"](spark, __spark_entry__.SMALL)
    for name in ("orders", "order_reviews"):
        files = seen.value.args[0][name].inputFiles()
        assert files and all(f"/sources/{name}/" in f for f in files)


def test_order_snapshot_is_stored_as_versions(spark, tmp_path):
    schema = "order_id int, order_status string, order_purchase_timestamp string"
    first = spark.createDataFrame([(1, "created", "t"), (2, "created", "t")], schema)
    second = spark.createDataFrame([(1, "shipped", "t"), (2, "created", "t")], schema)
    build.take_snapshot(spark, first, str(tmp_path / "s"), F.lit(DAY(1)))
    got = build.take_snapshot(spark, second, str(tmp_path / "s"), F.lit(DAY(2)))
    assert as_set(got, "order_id", "order_status", "valid_from", "valid_to") == {
        (1, "created", DAY(1), DAY(2)), (1, "shipped", DAY(2), None), (2, "created", DAY(1), None)}


def test_day_differences_across_midnight(spark):
    df = spark.sql("select timestamp'2018-01-01 23:00:00' a, timestamp'2018-01-02 01:00:00' b, "
                   "'2018-01-02 01:00:00' x, '2018-01-01 23:00:00' y")
    row = df.select(X.calendar_days("a", "b").alias("c"), X.elapsed_days("a", "b").alias("e"),
                    X.whole_days_between_texts("x", "y").alias("w")).first()
    assert (row.c, row.e, row.w) == (1, 0, -1)


def test_keys_tell_null_from_empty_and_ratios_survive_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    assert df.select(X.surrogate_key("x", "y")).distinct().count() == 2
    assert spark.range(1).select(X.ratio(F.lit(1), F.lit(0), 2).alias("r")).first().r is None
    assert spark.range(1).select(X.percent(F.lit(1), F.lit(8), 1).alias("r")).first().r == 12.5


def test_ranking_and_salted_counts(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("b", 3, 1), (None, 4, 2)], "g string, id int, v int")
    best = ranking.best_per_group(df, ["g"], "v")
    assert {r.id for r in best.collect()} == {1, 2, 3, 4}
    top = ranking.top_n(df, 2, [F.desc("v"), F.asc("id")], rank="place", at_least=F.col("v") > 1)
    assert [(r.id, r.place) for r in top.orderBy("place").collect()] == [(1, 1), (2, 2)]
    salted = aggregates.salted_agg(df.repartition(4), ["g"], {"v": F.col("v")}, 3)
    assert as_set(salted, "g", "rows", "v") == {("a", 2, 10), ("b", 1, 1), (None, 1, 2)}
    assert as_set(joins.orphans(df, df.filter("id = 3"), "g", "g"), "id") == {(1,), (2,)}
