from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewind.operators import quality as Q


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None), (None, 2.0)], "k int, v double")


def rules(**actions):
    conditions = {"positive": F.col("v") > 0, "keyed": F.col("k").isNotNull()}
    return [Q.Rule(n, conditions[n], a) for n, a in actions.items()]


def test_null_predicate_is_a_violation_for_every_action(rows):
    kept, counts = Q.apply_expectations(rows, rules(positive=Q.WARN))
    assert counts == {"positive": 2} and kept.count() == 4
    kept, counts = Q.apply_expectations(rows, rules(positive=Q.DROP))
    assert counts == {"positive": 2} and sorted(kept.collect(), key=repr) == sorted(
        [r for r in rows.collect() if r.v is not None and r.v > 0], key=repr)
    with pytest.raises(Q.RuleFailed, match="positive"):
        Q.apply_expectations(rows, rules(positive=Q.FAIL))


def test_warnings_look_at_kept_rows_only(rows):
    _, counts = Q.apply_expectations(rows, rules(positive=Q.WARN, keyed=Q.DROP))
    assert counts == {"positive": 2, "keyed": 1}
    report = {r.rule: (r.action, r.violations) for r in Q.expectation_report(
        rows, rules(positive=Q.DROP, keyed=Q.WARN)).collect()}
    assert report == {"positive": ("drop", 2), "keyed": ("warn", 1)}


def test_no_rules_and_no_rows(spark, rows):
    assert Q.apply_expectations(rows, []) == (rows, {})
    _, counts = Q.apply_expectations(rows.limit(0), rules(positive=Q.FAIL))
    assert counts == {"positive": 0}


def test_table_tests_let_null_pass_except_not_null(spark, rows):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    t = {"r": rows.unionByName(rows.limit(1)), "p": parent}
    now = F.lit(datetime(2024, 1, 1))
    t["e"] = spark.createDataFrame([(datetime(2023, 12, 30),), (datetime(2024, 1, 2),), (None,)], "at timestamp")
    tests = [Q.not_null("r", "v"), Q.unique("r", "k"), Q.unique("r", "k", "v"),
             Q.accepted_values("r", "k", [1, 2]), Q.relationship("r", "k", "p", "id"),
             Q.in_range("r", "v", low=0, high=4), Q.not_in_future("e", "at", now),
             Q.fresh("e", "at", 24, F.lit(datetime(2024, 1, 5))), Q.not_null("p", "id"),
             Q.not_null("r", "k", severity=Q.WARN)]
    got = {r.test: (r.failing_rows, r.status) for r in Q.run_tests(t, tests).collect()}
    assert got == {
        "r.v not_null": (1, "fail"), "r.k unique": (1, "fail"), "r.k+v unique": (1, "fail"),
        "r.k accepted_values": (1, "fail"), "r.k references p": (1, "fail"),
        "r.v in_range": (3, "fail"), "e.at not_in_future": (1, "fail"),
        "e.at fresh": (1, "warn"), "p.id not_null": (0, "pass"), "r.k not_null": (1, "warn")}
    with pytest.raises(Q.TestsFailed, match="r.v not_null"):
        Q.require_passing(t, tests)
    assert len(Q.require_passing(t, tests[-2:])) == 2


def test_empty_table_passes_all_but_freshness(spark, rows):
    t = {"r": rows.limit(0)}
    tests = [Q.not_null("r", "v"), Q.unique("r", "k"), Q.in_range("r", "v", low=0)]
    assert {r.status for r in Q.run_tests(t, tests).collect()} == {"pass"}
