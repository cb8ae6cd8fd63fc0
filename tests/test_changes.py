import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewind.operators import changes as C

T0 = datetime(2024, 1, 1)


def at(n):
    return T0 + timedelta(hours=n)


def frame(spark, rows, schema="k int, s timestamp, a string, b int"):
    return spark.createDataFrame(rows, schema)


def reference_scd2(rows, fill, tracked=("a",)):
    """Brute force over (k, s, a, b), one row per key and sequence."""
    out = []
    for key in sorted({r[0] for r in rows}):
        state, versions = {"a": None, "b": None}, []
        for _, s, a, b in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            new = {"a": a, "b": b}
            if fill:
                new = {c: state[c] if v is None else v for c, v in new.items()}
            if not versions or any(new[c] != state[c] for c in tracked):
                if versions:
                    versions[-1][4] = s
                versions.append([key, None, None, s, None])
            versions[-1][1:3] = [new["a"], new["b"]]
            state = new
        out += [tuple(v) for v in versions]
    return sorted(out, key=repr)


def test_scd1_latest_row_wins_whatever_the_order(spark):
    rows = [(1, at(1), "new", 1), (1, at(3), None, 3), (1, at(2), "mid", 2), (2, at(1), "x", None)]
    for sample in (rows, rows[::-1]):
        got = C.scd1(frame(spark, sample), ["k"], "s").orderBy("k").collect()
        assert [tuple(r) for r in got] == [(1, at(3), None, 3), (2, at(1), "x", None)]


def test_scd1_ignores_null_updates_per_column(spark):
    rows = [(1, at(1), "new", 1), (1, at(3), None, 3), (1, at(2), "mid", None), (2, at(1), None, None)]
    got = C.scd1(frame(spark, rows), ["k"], "s", ignore_null_updates=True).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, at(3), "mid", 3), (2, at(1), None, None)]


@pytest.mark.parametrize("ignore", [True, False])
def test_scd1_states_merge_in_any_split(spark, ignore):
    rng = random.Random(5)
    rows = [(rng.randrange(4), at(rng.randrange(9)), rng.choice(["x", "y", None]),
             rng.choice([1, 2, None])) for _ in range(60)]
    whole = sorted(map(repr, C.scd1(frame(spark, rows), ["k"], "s", ignore).collect()))
    parts = [rows[:20], rows[10:45], rows[40:], rows[:5]]
    states = None
    for part in parts:
        state = C.scd1_state(frame(spark, part), ["k"], "s", ignore)
        states = state if states is None else C.merge_states(states.unionByName(state), ["k"])
    split = C.scd1_rows(states, ["k"]).select("k", "s", "a", "b").collect()
    assert sorted(map(repr, split)) == whole


def test_scd1_composite_key_and_ties_resolve_the_same(spark):
    rows = [(1, at(1), "p", 1), (1, at(1), "q", 2)]
    first = C.scd1(frame(spark, rows), ["k", "s"], "b").collect()
    assert [tuple(r) for r in first] == [(1, at(1), "q", 2)]
    tied = {tuple(C.scd1(frame(spark, r), ["k"], "s").first()) for r in (rows, rows[::-1])}
    assert len(tied) == 1


def test_scd2_returning_to_an_old_value_opens_a_new_version(spark):
    rows = [(1, at(i), v, i) for i, v in enumerate(["new", None, "shipped", "shipped", "new"], 1)]
    got = C.scd2(frame(spark, rows), ["k"], "s", ["b"], ignore_null_updates=True)
    got = got.select("k", "a", "b", C.START, C.END).orderBy(C.START).collect()
    assert [tuple(r) for r in got] == [
        (1, "new", 2, at(1), at(3)), (1, "shipped", 4, at(3), at(5)), (1, "new", 5, at(5), None)]


@pytest.mark.parametrize("fill", [True, False])
@pytest.mark.parametrize("seed", range(3))
def test_scd2_matches_brute_force_and_cut_keys_match_uncut(spark, fill, seed):
    rng = random.Random(seed)
    rows = {}
    for _ in range(400):
        k, s = rng.choice([1, 1, 1, 2, 3]), at(rng.randrange(300))
        rows[k, s] = (k, s, rng.choice(["x", "y", None]), rng.choice([1, 2, 3, None]))
    rows = list(rows.values())
    want = reference_scd2(rows, fill)
    for limit in (10 ** 6, 40, 7):
        got = C.scd2(frame(spark, rows), ["k"], "s", ["b"], ignore_null_updates=fill,
                     max_rows_per_key=limit)
        got = [tuple(r) for r in got.select("k", "a", "b", C.START, C.END).collect()]
        assert sorted(got, key=repr) == want, limit


def test_scd2_intervals_never_overlap_and_only_the_last_is_open(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(5), at(rng.randrange(50)), rng.choice("xyz"), 1) for _ in range(300)]
    got = C.scd2(frame(spark, rows), ["k"], "s").collect()
    for key in range(5):
        mine = sorted((r for r in got if r.k == key), key=lambda r: r[C.START])
        assert all(a[C.END] == b[C.START] for a, b in zip(mine, mine[1:]))
        assert mine[-1][C.END] is None


def test_current_and_as_of_time(spark):
    rows = [(1, at(1), "x", 0), (1, at(4), "y", 0), (2, at(3), "z", 0)]
    versions = C.scd2(frame(spark, rows), ["k"], "s", ["b"])
    assert sorted(r.a for r in C.current(versions).collect()) == ["y", "z"]
    assert [r.a for r in C.as_of_time(versions, F.lit(at(2))).collect()] == ["x"]
    assert sorted(r.a for r in C.as_of_time(versions, F.lit(at(4))).collect()) == ["y", "z"]


def test_merge_updates_inserts_and_leaves_null_keys_alone(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 3)], "k int, v string, w int")
    source = spark.createDataFrame([(2, None, 9), (3, "c", 8), (None, "m", 7)], "k int, v string, w int")
    got = {tuple(r) for r in C.merge(target, source, ["k"]).collect()}
    assert got == {(1, "a", 1), (2, None, 9), (3, "c", 8), (None, "n", 3), (None, "m", 7)}
    partial = {tuple(r) for r in C.merge(target, source, ["k"], ["w"], insert=False).collect()}
    assert partial == {(1, "a", 1), (2, "b", 9), (None, "n", 3)}


def test_merge_refuses_two_source_rows_for_one_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(C.DuplicateSourceKey):
        C.merge(target, source, ["k"])


def test_incremental_takes_newer_rows_only(spark):
    schema = "k int, ts timestamp, v string"
    target = spark.createDataFrame([(1, at(1), "a"), (2, at(5), "b")], schema)
    source = spark.createDataFrame(
        [(1, at(1), "late"), (2, at(5), "same"), (2, at(6), "new"), (3, at(7), "c")], schema)
    got = {tuple(r) for r in C.incremental(target, source, ["k"], "ts").collect()}
    assert got == {(1, at(1), "a"), (2, at(6), "new"), (3, at(7), "c")}
    assert C.incremental(None, source, ["k"], "ts").count() == 4
    assert C.incremental(target, source, ["k"], "ts", full_refresh=True).count() == 4
    with pytest.raises(C.DuplicateSourceKey):
        C.incremental(target, source, ["k"], "ts", lookback="1 hour")


def test_snapshot_opens_closes_and_keeps_vanished_keys(spark):
    schema = "k int, status string, x int"
    run = lambda n: F.lit(at(n))
    first = C.snapshot_check(None, spark.createDataFrame(
        [(1, "a", 1), (2, "b", 1), (3, None, 1)], schema), ["k"], ["status"], run(1))
    same = C.snapshot_check(first, spark.createDataFrame(
        [(1, "a", 2), (2, "b", 2), (3, None, 2)], schema), ["k"], ["status"], run(2))
    assert same.exceptAll(first).isEmpty() and same.count() == 3
    third = C.snapshot_check(same, spark.createDataFrame(
        [(1, "z", 5), (3, "c", 5), (4, "d", 5)], schema), ["k"], ["status"], run(3))
    got = {tuple(r) for r in third.collect()}
    assert got == {(1, "a", 1, at(1), at(3)), (1, "z", 5, at(3), None), (2, "b", 1, at(1), None),
                   (3, None, 1, at(1), at(3)), (3, "c", 5, at(3), None), (4, "d", 5, at(3), None)}


def test_short_stretches_share_tasks(spark):
    rows = spark.range(3000).selectExpr("id % 3 as k", "id as s", "cast(id as string) as v")
    cut = C._stretches(rows, ["k"], "s", 8).withColumn("piece", F.col("_metadata.file_path"))
    found = cut.groupBy("k", "__part").agg(F.count("*").alias("n"), F.min("s").alias("a"), F.max("s").alias("b"))
    assert found.agg(F.max("n")).first()[0] <= 4 and cut.select("piece").distinct().count() <= 2
    following = sorted(tuple(r) for r in found.select("k", "__part", "a", "b").collect())
    assert all(x[3] < y[2] for x, y in zip(following, following[1:]) if x[0] == y[0])
    assert cut.count() == 3000


def test_latest_rows_carry_their_order_once(spark):
    """What a row is ordered by is not sorted and shuffled twice."""
    rows = frame(spark, [(1, at(2), "p", 1), (1, at(1), "q", 2), (2, None, "r", None), (None, at(1), "n", 3)])
    latest = C.scd1(rows.withColumn(C.PROVENANCE[1], F.col("a")), ["k"], "s")
    assert {tuple(r) for r in latest.collect()} == {
        (1, at(2), "p", 1, "p"), (2, None, "r", None, "r"), (None, at(1), "n", 3, "n")}
    plan = latest._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("s, s#") == 1
