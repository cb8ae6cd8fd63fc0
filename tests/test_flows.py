"""Change flows over many batches, other bucket counts, restores and rules; the stages as whole runs."""

import os
import random
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tradewind.operators import changes as C
from tradewind.operators.quality import DROP, FAIL, WARN, Rule
from tradewind.plans.silver import ChangeTable
from tradewind.sources import versions as V
from tradewind.streaming import flows, ingest


def rules():
    return [Rule("has_value", F.col("v").isNotNull()),
            Rule("not_bad", F.coalesce(F.col("v") != "bad", F.lit(True)), DROP)]


class Table:
    def __init__(self, spark, tmp_path, scd_type=1, spec=None):
        self.spark, self.root, self.scd_type = spark, str(tmp_path), scd_type
        self.spec = spec or ChangeTable(["k"], rules(), [], sequence_by="s")
        self.target = f"{self.root}/silver"

    def apply(self, rows, **options):
        (self.spark.createDataFrame(rows, "k long, s long, v string").coalesce(1).write.mode("append")
         .parquet(f"{self.root}/bronze"))
        return flows.change_flow(self.spark, f"{self.root}/bronze", lambda df: df, self.spec, self.target,
                                 f"{self.root}/ck", self.scd_type, **options)

    def rows(self):
        df = (flows.read_type1(self.spark, self.target, ["k"]) if self.scd_type == 1
              else flows.read_type2(self.spark, self.target))
        return sorted(tuple(r) for r in df.select("k", "s", "v").collect())


def test_counts_beyond_the_progress_window(spark, tmp_path):
    window = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(window)
    spark.conf.set(window, "2")
    try:
        spark.range(24).selectExpr("id", "cast(null as string) as v").repartition(8).write.parquet(f"{tmp_path}/in")
        assert ingest.ingest_files(spark, f"{tmp_path}/in", "parquet", f"{tmp_path}/out", f"{tmp_path}/ck",
                                   files_per_batch=1) == 24
        rows = flows.stream_of(spark, f"{tmp_path}/out", files_per_batch=1)
        found = flows.append_flow(rows, [Rule("v", F.col("v").isNotNull(), WARN)], f"{tmp_path}/silver", f"{tmp_path}/ck2")
        assert found == {"v": 24} and spark.read.parquet(f"{tmp_path}/silver").count() == 24
    finally:
        spark.conf.set(window, before)


def test_another_bucket_count_keeps_keys_and_values(spark, tmp_path):
    table = Table(spark, tmp_path)
    table.apply([(k, 1, f"a{k}") for k in range(40)], buckets=4)
    table.apply([(k, 2, None) for k in range(3)] + [(99, 2, "new")], buckets=8)
    assert table.rows() == sorted([(k, 2 if k < 3 else 1, f"a{k}") for k in range(40)] + [(99, 2, "new")])
    assert V.bucketing(spark, table.target) == (["k"], 8)
    table.apply([(5, 3, "later")])  # the stored number counts
    assert V.bucketing(spark, table.target)[1] == 8 and (5, 3, "later") in table.rows()
    with pytest.raises(V.BucketMismatch):
        V.publish(V.as_of_version(spark, table.target), table.target, "x", ["k"], 4, touched=[0])


def test_type2_with_another_bucket_count_and_untouched_keys(spark, tmp_path):
    table = Table(spark, tmp_path, 2)
    table.apply([(k, 1, f"a{k}") for k in range(30)], buckets=4)
    table.apply([(k, 2, "b") for k in range(5)], buckets=8)
    table.apply([(0, 0, "early")])
    assert table.rows() == sorted([(k, 1, f"a{k}") for k in range(30)] + [(k, 2, "b") for k in range(5)] + [(0, 0, "early")])


def test_restore_takes_type2_changes_back_for_good(spark, tmp_path):
    table = Table(spark, tmp_path, 2)
    table.apply([(k, 1, "a") for k in range(40)], buckets=4)
    table.apply([(k, 2, "undone") for k in range(40)])
    assert V.restore(spark, table.target, 0) == 2
    assert table.rows() == [(k, 1, "a") for k in range(40)]
    table.apply([(7, 3, "c")])
    assert table.rows() == sorted([(k, 1, "a") for k in range(40)] + [(7, 3, "c")])


def test_as_of_a_time(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in range(2):
        V.publish(spark.range(n + 1), path, "write")
    first = V.versions(spark, path).filter("version = 0").selectExpr("cast(published_at as string)").first()[0]
    assert V.as_of_version(spark, path, moment=first).count() == 1
    assert V.as_of_version(spark, path, moment="2000-01-01") is None
    with pytest.raises(ValueError):
        V.restore(spark, path, 9)


def test_rule_results_stay_with_the_table_and_fail_stops(spark, tmp_path):
    table = Table(spark, tmp_path)
    assert table.apply([(1, 1, None), (2, 1, "bad"), (3, 1, "x")]) == {"has_value": 1, "not_bad": 1}
    table.apply([(4, 1, "bad")])
    found = {(r["batch_id"], r["rule"], r["action"]): r["violations"] for r in flows.rule_results(spark, table.target).collect()}
    assert found[0, "not_bad", DROP] == 1 and found[1, "not_bad", DROP] == 1 and found[1, "has_value", WARN] == 0
    strict = Table(spark, tmp_path / "strict", spec=ChangeTable(["k"], [Rule("set", F.col("v").isNotNull(), FAIL)], [], "s"))
    with pytest.raises(Exception, match="set"):
        strict.apply([(1, 1, None)])
    assert V.latest_version(spark, strict.target) is None


@pytest.mark.parametrize("most", [1000, 3])
def test_scd2_is_the_same_for_keys_of_every_size(spark, most):
    rows = [(k, f"{s:03d}", "xyz"[s // 4 % 3]) for k in (None, 1, 2) for s in range(20)]
    df = spark.createDataFrame(rows, "k long, s string, v string")
    got = sorted((tuple(r) for r in C.scd2(df, ["k"], "s", max_rows_per_key=most).select("k", "v", C.START, C.END).collect()), key=repr)
    edges = ["000", "004", "008", "012", "016", None]
    assert got == sorted(((k, "xyz"[i % 3], edges[i], edges[i + 1]) for k in (None, 1, 2) for i in range(5)), key=repr)
    gap = df.union(spark.createDataFrame([(1, None, "z")], df.schema))
    assert C.without_sequence(gap, "s").count() == 1
    assert C.scd2(gap, ["k"], "s", max_rows_per_key=most, on_missing_sequence="skip").count() == 15
    with pytest.raises(Exception, match="MissingSequence"):
        C.scd2(gap, ["k"], "s", max_rows_per_key=most).collect()


def test_incremental_fills_an_empty_target(spark):
    source = spark.createDataFrame([(1, 5), (2, None)], "k long, at long")
    assert C.incremental(source.limit(0), source, ["k"], "at").count() == 2
    filled = C.incremental(source.filter("k = 1"), source, ["k"], "at")
    assert sorted(tuple(r) for r in filled.collect()) == [(1, 5)]


def test_timely_changes_extend_open_versions_without_the_history(spark, tmp_path):
    table = Table(spark, tmp_path, 2)
    table.apply([(k, 1, f"a{k}") for k in range(6)] + [(None, 1, "n")], buckets=4)
    (tmp_path / "silver_changes").rename(tmp_path / "away")  # nothing may need what came before
    table.apply([(0, 2, "a0"), (0, 3, "b"), (1, 5, None), (2, 2, "c"), (9, 1, "new"), (None, 4, "m")])
    got = {(r.k, r.v, r[C.START], r[C.END], r.s) for r in flows.read_type2(spark, table.target).collect()}
    assert got == {(0, "a0", 1, 3, 2), (0, "b", 3, None, 3), (1, "a1", 1, None, 5), (2, "a2", 1, 2, 1), (2, "c", 2, None, 2),
                   (3, "a3", 1, None, 1), (4, "a4", 1, None, 1), (5, "a5", 1, None, 1), (9, "new", 1, None, 1),
                   (None, "n", 1, 4, 1), (None, "m", 4, None, 4)}


def test_late_and_timely_changes_give_what_all_at_once_give(spark, tmp_path):
    rng = random.Random(3)
    spec = ChangeTable(["k"], [], ["v"], sequence_by="s", track_except=["w"])
    row = lambda low, high: (rng.choice([None, *range(6)]), rng.randrange(low, high), rng.choice(["a", "b", None]),
                             rng.choice([None, rng.randrange(9)]))
    parts = [[row(0, 20) for _ in range(40)], [row(20, 30) for _ in range(15)], [row(5, 50) for _ in range(12)]]
    shape = "k long, s long, v string, w int"
    for n, part in enumerate(parts):
        spark.createDataFrame(part, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/b")
        flows.change_flow(spark, f"{tmp_path}/b", lambda df: df, spec, f"{tmp_path}/t", f"{tmp_path}/ck", 2, buckets=4,
                          max_rows_per_key=1000 if n < 2 else 3)
    everything = spark.createDataFrame([r for p in parts for r in p], shape)
    want = C.scd2(everything, ["k"], "s", ["w"], ignore_null_updates=True)
    columns = ["k", "s", "v", "w", C.START, C.END]
    show = lambda df: sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert show(flows.read_type2(spark, f"{tmp_path}/t")) == show(want)


def test_a_growing_table_gets_more_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(flows, "ROWS_PER_BUCKET", 2)
    table = Table(spark, tmp_path)
    table.apply([(k, 1, "a") for k in range(40)], buckets=4)
    table.apply([(1, 2, "b")])
    assert V.newest(spark, table.target).bucket_count == flows.buckets_for(40) == 32
    assert V.newest(spark, table.target).total == 40 and (1, 2, "b") in table.rows()


def test_states_hold_one_order_a_row_and_merge_in_any_split(spark):
    """Also when a column is added after a newer row was stored without it."""
    rows = [(1, 1, "a", "x"), (1, 3, None, "y"), (1, 2, "b", None), (2, 5, None, None), (2, 4, "c", None)]
    df = spark.createDataFrame(rows, "k long, s long, v string, w string")
    whole = C.scd1(df, ["k"], "s", ignore_null_updates=True)
    assert sorted(tuple(r) for r in whole.collect()) == [(1, 3, "b", "y"), (2, 5, "c", None)]
    state = lambda part: C.scd1_state(part, ["k"], "s", ignore_null_updates=True)
    merged = C.merge_states(state(df.filter("s % 2 = 0")).union(state(df)).union(state(df.filter("s > 2"))), ["k"])
    assert sorted(tuple(r) for r in C.scd1_rows(merged, ["k"]).select("k", "s", "v", "w").collect()) == [(1, 3, "b", "y"), (2, 5, "c", None)]
    narrow = state(spark.createDataFrame([(1, 9, "new")], "k long, s long, v string"))
    both = C.split_incomplete(narrow.unionByName(state(df), allowMissingColumns=True), ["k"])
    wide = C.scd1_rows(C.merge_states(both, ["k"]), ["k"]).select("k", "s", "v", "w")
    assert sorted(tuple(r) for r in wide.collect()) == [(1, 9, "new", "y"), (2, 5, "c", None)]


def test_inserts_of_a_changing_table_arrive_once(spark, tmp_path):
    table = Table(spark, tmp_path)
    read = lambda df: C.scd1_rows(df, ["k"])
    take = lambda: flows.insert_flow(spark, table.target, ["k"], f"{tmp_path}/new", f"{tmp_path}/ck-new", read)
    seen = lambda: sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/new").select("k", "s", "v").collect())
    table.apply([(k, 1, "a") for k in range(3)], buckets=4)
    assert take() == [0] and seen() == [(k, 1, "a") for k in range(3)]
    table.apply([(0, 2, "changed"), (7, 2, "added")])
    V.restore(spark, table.target, 0)
    V.rebucket(spark, table.target, 8)
    assert take() == [1, 3] and seen() == [*[(k, 1, "a") for k in range(3)], (7, 2, "added")]
    assert take() == []


def test_parts_of_a_type2_table_are_sorted_by_their_cluster_columns(spark, tmp_path):
    """Also after batches that touch only some of them: every file holds its rows in that order."""
    spec = ChangeTable(["k"], [], ["v", "k"], sequence_by="s")
    table = Table(spark, tmp_path, 2, spec)
    table.apply([(k, 1, f"v{k % 7}") for k in range(60)], buckets=4)
    table.apply([(k, 2, f"v{k % 5}") for k in range(0, 60, 9)])
    table.apply([(3, 3, "v0")])
    known = V.newest(spark, table.target)
    for part, version in known.placed.items():
        for name in (tmp_path / "silver" / "data" / f"version={version}" / f"{V.BUCKET}={part}").glob("*.parquet"):
            held = [(r["v"], r["k"]) for r in pq.read_table(name).to_pylist()]
            assert held == sorted(held) and held


@pytest.mark.parametrize("scd_type", [1, 2])
def test_a_batch_into_parts_that_hold_nothing(spark, tmp_path, scd_type):
    table = Table(spark, tmp_path, scd_type)
    part = {r.k: r.b for r in spark.range(20).select(F.col("id").alias("k"), V.X.key_bucket(["id"], 16).alias("b")).collect()}
    other = next(k for k in part if part[k] != part[0])
    table.apply([(0, 1, "a")], buckets=16)
    table.apply([(other, 1, "b")])
    assert table.rows() == [(0, 1, "a"), (other, 1, "b")] and V.newest(spark, table.target).total == 2


def test_late_changes_of_every_stored_key_keep_the_total(spark, tmp_path):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = Table(spark, tmp_path, 2)
        table.apply([(k, 5, "a") for k in range(40)], buckets=4)
        table.apply([(k, 1, "early") for k in range(40)])
        assert table.rows() == sorted([(k, 1, "early") for k in range(40)] + [(k, 5, "a") for k in range(40)])
        assert V.newest(spark, table.target).total == 80
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


@pytest.mark.parametrize("heavy", [False, True])
def test_a_type1_batch_is_shuffled_once_and_its_changes_hold_their_order_once(spark, tmp_path, monkeypatch, heavy):
    """Unless a key has very many changes, which are combined before they meet the stored ones."""
    plans, publish, spec = [], V.publish, ChangeTable(["k"], [], [], sequence_by="s")
    monkeypatch.setattr(V, "publish", lambda df, *a, **o: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or publish(df, *a, **o))
    table = Table(spark, tmp_path, 1, spec)
    limit = {"max_rows_per_key": 0 if heavy else 1000}
    table.apply([(k, 1, None if k % 2 else "a") for k in range(40)] + [(None, 1, "n")], buckets=4, **limit)
    held = V.as_of_version(spark, table.target)
    assert sorted(held.columns) == [C.HELD, "k"] and held.filter(F.size(C.HELD) != 1).isEmpty()
    table.apply([(k, 2, None) for k in range(20)] + [(None, 2, None)] + [(0, 0, "late")] * 5, **limit)
    got = {r[0]: r[1:] for r in map(tuple, flows.read_type1(spark, table.target, ["k"]).select("k", "s", "v").collect())}
    assert got == {**{k: (2 if k < 20 else 1, None if k % 2 else "a") for k in range(40)}, None: (2, "n")}
    assert [len(re.findall(r"\bExchange\b", plan)) for plan in plans] == ([2, 2] if heavy else [1, 1])
    files = spark.read.parquet(f"{table.target}/data").select(F.input_file_name()).distinct().count()
    assert files <= 8


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    names = env.blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {n for n in names if n.endswith(".data") and "/shuffle_" in n}


def test_a_type1_batch_leaves_no_shuffled_rows_on_disk_and_shuffles_each_column_once(spark, tmp_path, monkeypatch):
    plans, publish = [], V.publish
    monkeypatch.setattr(V, "publish", lambda df, *a, **o: plans.append(
        df._jdf.queryExecution().optimizedPlan().toString()) or publish(df, *a, **o))
    table = Table(spark, tmp_path, 1, ChangeTable(["k"], [], [], sequence_by="s"))
    before = shuffle_files(spark)
    table.apply([(k, 1, f"a{k}") for k in range(20000)], buckets=4)
    table.apply([(k, k % 3, f"b{k}") for k in range(5000, 25000)])
    left = sum(os.path.getsize(n) for n in shuffle_files(spark) - before if os.path.exists(n))
    assert left < 20000
    assert all(spark.conf.get(k, None) != v for k, v in flows.BATCH_CONF.items())  # set for the stream alone
    for plan in plans:  # the order of a row is made of it behind the shuffle
        above, _, below = plan.partition("RepartitionByExpression")
        assert "xxhash64(s" in above and "xxhash64(s" not in below
    want = {k: ("a", 1) if k < 5000 else ("b", k % 3) if k >= 20000 or k % 3 == 2 else ("a", 1) if k % 3 == 0 else None
            for k in range(25000)}
    got = {r.k: (r.v[0], r.s) for r in flows.read_type1(spark, table.target, ["k"]).collect()}
    assert got.keys() == want.keys() and all(w is None or got[k] == w for k, w in want.items())
    kept = pq.ParquetFile(next((tmp_path / "silver" / "data" / "version=1").glob("*/*.parquet"))).metadata
    assert kept.row_group(0).column(0).compression == "ZSTD"


def test_thin_orders_become_the_full_ones(spark):
    """Of changes that won some of their values only, of plain ones, and where one side has no provenance."""
    shape = "k long, s long, v string, _source_file string"
    rows = [(1, 5, "x", "f1"), (1, 7, None, "f2"), (2, None, "y", None), (2, 1, None, "f1"), (3, 2, None, None),
            (4, 9, None, "f2"), (4, 3, "z", None)]
    old = C.with_order(spark.createDataFrame(rows, shape), ["k"], "s")
    held = C.held_changes(C.merge_changes(old, ["k"]), ["k"])
    values = ["s", "v", "_source_file"]
    show = lambda df: sorted((repr(r.asDict(True)) for r in df.select("k", *values, C.ORDER).collect()))
    thin = C.thin_order(held, "s")
    assert show(C.full_order(thin, "s", values)) == show(held)
    assert show(C.full_order(C.thin_order(thin, "s"), "s", values)) == show(held)
    assert thin.filter(F.col("s").isNotNull() & F.col(C.ORDER)["s"].isNotNull()).isEmpty()
    assert not thin.filter(F.col("s").isNull() & F.col(C.ORDER)["s"].isNotNull()).isEmpty()
    new = spark.createDataFrame(rows, shape)
    assert show(C.full_order(new, "s", values)) == show(old)
    met = C.full_order(new.unionByName(thin, allowMissingColumns=True), "s", values)
    assert show(met) == sorted([*show(old), *show(held)])
    bare = new.drop("_source_file")
    mixed = C.full_order(bare.unionByName(thin, allowMissingColumns=True), "s", ["s", "v"])
    assert mixed.schema[C.ORDER].dataType.names == ["s", "p1", "h"] and mixed.count() == len(rows) + held.count()
