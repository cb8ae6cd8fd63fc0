"""Stored facts and snapshots: what a run leaves alone keeps its files."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from tradewind.sources import growing
from tradewind.sources import versions as V

DAY = lambda month, day=1: dt.datetime(2024, month, day)


def orders(spark, rows):
    return spark.createDataFrame(rows, "k long, at timestamp_ntz, v string")


def files(path, *parts):
    return {f for p in parts for f in glob.glob(f"{path}/data/version=*/__bucket={p}/*.parquet")}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def month(m):
    return 12 * 2024 + m - 1


def test_months_without_new_rows_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = [(m * 10 + i, DAY(m, 1 + i), "a") for m in (1, 2, 3) for i in range(3)] + [(99, None, "no time")]
    growing.grow_by_month(spark, orders(spark, first), path, ["k"], "at")
    before = files(path, "*")
    # a new row, a correction that moves an old key, and one that is too old to be taken
    new = [(40, DAY(4), "b"), (11, DAY(3, 9), "moved"), (20, DAY(2), "not newer"), (98, None, "no time")]
    got = rows(growing.grow_by_month(spark, orders(spark, new), path, ["k"], "at"))
    assert got == sorted([r for r in first if r[0] != 11] + new[:2], key=repr)
    placed = V.newest(spark, path).placed
    assert placed == {0: 0, month(1): 1, month(2): 0, month(3): 1, month(4): 1}
    assert before <= files(path, "*") and files(path, month(2)) == {f for f in before if f"={month(2)}/" in f}
    growing.grow_by_month(spark, orders(spark, new), path, ["k"], "at")
    assert V.latest_version(spark, path) == 1  # nothing newer, nothing written
    again = growing.grow_by_month(spark, orders(spark, [(40, DAY(3, 31), "late")]), path, ["k"], "at", lookback="2 days")
    assert [r[2] for r in rows(again) if r[0] == 40] == ["late"]
    assert rows(growing.grow_by_month(spark, orders(spark, first[:2]), path, ["k"], "at", full_refresh=True)) == first[:2]


def test_an_empty_fact_takes_everything(spark, tmp_path):
    path = str(tmp_path / "fact")
    growing.grow_by_month(spark, orders(spark, []), path, ["k"], "at")
    assert rows(growing.grow_by_month(spark, orders(spark, [(1, None, "x")]), path, ["k"], "at")) == [(1, None, "x")]


def test_closed_rows_are_written_once(spark, tmp_path):
    path = str(tmp_path / "snap")

    def run(day, **statuses):
        df = spark.createDataFrame([(k, s, day) for k, s in statuses.items()], "k string, s string, seen int")
        return rows(growing.grow_snapshot(spark, df, path, ["k"], ["s"], F.lit(DAY(1, day)).cast("timestamp_ntz"), rows_per_bucket=1))

    run(1, a="new", b="new", c="new", d="new")
    run(2, a="sent", b="new", c=None, e="new")
    shelf = files(path, growing.OPEN_PARTS + 1)
    assert shelf
    got = run(3, a="done", b="new", c=None)
    assert got == sorted([
        ("a", "new", 1, DAY(1, 1), DAY(1, 2)), ("a", "sent", 2, DAY(1, 2), DAY(1, 3)), ("a", "done", 3, DAY(1, 3), None),
        ("b", "new", 1, DAY(1, 1), None), ("c", "new", 1, DAY(1, 1), DAY(1, 2)), ("c", None, 2, DAY(1, 2), None),
        ("d", "new", 1, DAY(1, 1), None), ("e", "new", 2, DAY(1, 2), None)], key=repr)
    assert files(path, growing.OPEN_PARTS + 1) == shelf and files(path, growing.OPEN_PARTS + 2)
    last = V.newest(spark, path)
    assert run(3, a="done", b="new", c=None) == got and V.latest_version(spark, path) == last.version
    with pytest.raises(Exception, match="more than one"):
        growing.grow_snapshot(spark, spark.createDataFrame([("a", "x", 1)] * 2, "k string, s string, seen int"), path,
                              ["k"], ["s"], F.current_timestamp())
    V.restore(spark, path, 0)
    assert {r[1] for r in rows(V.as_of_version(spark, path))} == {"new"}


def test_totals_hold_where_adaptive_execution_drops_empty_branches(spark, tmp_path):
    path, was = str(tmp_path / "t"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed = spark.range(100).withColumnRenamed("id", "k")
        V.publish(keyed, path, "create", ["k"], 4)
        known = V.newest(spark, path)
        nothing = V.as_of_version(spark, path, known=known).join(keyed.repartition(3), "k", "left_anti")
        V.publish(nothing.repartition("k"), path, "delete", ["k"], 4, [0, 1])
        left = V.as_of_version(spark, path).count()
        assert V.newest(spark, path).total == left < 100 and sorted(V.newest(spark, path).placed) == [2, 3]
        V.publish(nothing, path, "clear", ["k"], 4)
        assert V.newest(spark, path).total == 0 and V.as_of_version(spark, path).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_many_small_buckets_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    path, parts, publish = str(tmp_path / "snap"), [], V.publish
    monkeypatch.setattr(V, "publish", lambda df, *a, **o: parts.append((df.rdd.getNumPartitions(), o.get("laid_out"))) or publish(df, *a, **o))
    for day, status in ((1, "new"), (2, "sent")):
        df = spark.range(200).select("id", F.lit(status).alias("s"))
        growing.grow_snapshot(spark, df, path, ["id"], ["s"], F.lit(DAY(1, day)).cast("timestamp_ntz"), rows_per_bucket=1)
    assert parts == [(4, True), (4, True)]  # 200 buckets, 64 a task
    got = V.as_of_version(spark, path).groupBy("s", F.col("valid_to").isNull().alias("open")).count()
    assert rows(got) == [("new", False, 200), ("sent", True, 200)]
