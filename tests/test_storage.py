import pytest
from pyspark.sql import functions as F

from tradewind.sources import landing, layout, tables
from tradewind.sources import versions as V


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_versions_read_back_and_restore(spark, tmp_path):
    path = str(tmp_path / "t")
    assert V.as_of_version(spark, path) is None and V.latest_version(spark, path) is None
    V.publish(keyed(spark, [(1, "a"), (2, "b")]), path, "create")
    V.publish(V.as_of_version(spark, path).filter("k = 1").union(keyed(spark, [(3, None)])), path, "merge")
    assert pairs(V.as_of_version(spark, path)) == {(1, "a"), (3, None)}
    assert pairs(V.as_of_version(spark, path, 0)) == {(1, "a"), (2, "b")}
    assert pairs(V.version_diff(spark, path, 0, 1, ["k"])) == {(2, "removed"), (3, "added")}
    assert V.restore(spark, path, 0) == 2
    assert pairs(V.as_of_version(spark, path)) == {(1, "a"), (2, "b")}
    assert [(r.version, r.operation, r.rows) for r in V.versions(spark, path).orderBy("version").collect()] == [
        (0, "create", 2), (1, "merge", 2), (2, "restore 0", 2)]


def test_unpublished_files_are_not_read_and_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    V.publish(keyed(spark, [(1, "a")]), path, "create")
    keyed(spark, [(9, "lost")]).write.parquet(V._files(path, 1))  # a writer that died
    assert pairs(V.as_of_version(spark, path)) == {(1, "a")}
    V.publish(keyed(spark, [(2, "b")]), path, "again")
    assert pairs(V.as_of_version(spark, path)) == {(2, "b")}


def test_bucketed_versions_rewrite_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    everything = keyed(spark, [(i, "old") for i in range(40)])
    V.publish(everything, path, "create", ["k"], 8)
    bucket_of = {r.k: r.b for r in everything.select("k", V.X.key_bucket(["k"], 8).alias("b")).collect()}
    touched = sorted({bucket_of[0], bucket_of[1]})
    part = V.as_of_version(spark, path, buckets=touched)
    assert {r.k for r in part.collect()} == {k for k, b in bucket_of.items() if b in touched}
    V.publish(part.withColumn("v", F.lit("new")), path, "touch", ["k"], 8, touched, "flow", 3)
    got = {r.k: r.v for r in V.as_of_version(spark, path).collect()}
    assert got == {k: "new" if b in touched else "old" for k, b in bucket_of.items()}
    assert pairs(V.as_of_version(spark, path, 0)) == pairs(everything)
    assert V.applied_up_to(V.newest(spark, path), "flow") == 3 and V.applied_up_to(None, "flow") == -1
    V.publish(keyed(spark, [(0, "only")]), path, "shrink", ["k"], 8)
    assert pairs(V.as_of_version(spark, path)) == {(0, "only")}


def test_landing_keeps_text_and_checks_files_first(spark, tmp_path):
    (tmp_path / "orders.csv").write_text("id,at\n007,2017-01-01\n")
    (tmp_path / "reviews.csv").write_text('id,message\n1,"two\nlines, ""quoted"""\n')
    files = {"orders": f"{tmp_path}/orders.csv", "order_reviews": f"{tmp_path}/reviews.csv"}
    counts = landing.prepare_landing(spark, files, f"{tmp_path}/landed")
    assert {tuple(r) for r in counts.collect()} == {("orders", 1), ("order_reviews", 1)}
    assert spark.read.parquet(f"{tmp_path}/landed/orders").first().asDict() == {"id": "007", "at": "2017-01-01"}
    assert spark.read.parquet(f"{tmp_path}/landed/order_reviews").first().message == 'two\nlines, "quoted"'
    with pytest.raises(landing.MissingFiles, match="none.csv"):
        landing.prepare_landing(spark, {**files, "x": f"{tmp_path}/none.csv"}, f"{tmp_path}/second")
    assert not (tmp_path / "second").exists()


def test_compaction_packs_files_and_keeps_rows(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") % 50).alias("a"), (F.col("id") % 37).alias("b"), "id")
    df.repartition(12).write.parquet(f"{tmp_path}/small")
    report = layout.compact(spark, f"{tmp_path}/small", f"{tmp_path}/packed", ["a", "b"],
                            target_bytes=layout.stored_bytes(spark, f"{tmp_path}/small") // 3).first()
    assert report.files <= 4
    packed = spark.read.parquet(f"{tmp_path}/packed")
    assert packed.exceptAll(df).isEmpty() and packed.count() == 2000


def test_clustered_files_hold_narrow_ranges(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    layout.write_clustered(df, f"{tmp_path}/c", ["k"], files=5)
    per_file = spark.read.parquet(f"{tmp_path}/c").groupBy("_metadata.file_path").agg(
        F.min("k").alias("low"), F.max("k").alias("high")).orderBy("low").collect()
    assert len(per_file) == 5
    assert all(a.high < b.low for a, b in zip(per_file, per_file[1:]))


def test_tables_by_name_give_the_same_rows_as_frames(spark):
    tables.publish_views(spark, {"pairs": keyed(spark, [(1, "a"), (2, "b")])}, prefix="t_")
    assert spark.sql("select count(*) n from t_pairs").first().n == spark.table("t_pairs").count() == 2


def test_one_hot_value_spreads_over_files(spark, tmp_path):
    """More files than distinct cluster values or z-values are still filled."""
    df = spark.range(4000).selectExpr("id", "0 as a", "1 as b", "uuid() as pad")
    layout.write_clustered(df, f"{tmp_path}/hot", ["a"], files=6)
    held = spark.read.parquet(f"{tmp_path}/hot").selectExpr("input_file_name() f").groupBy("f").count()
    assert held.count() >= 5 and held.agg({"count": "max"}).first()[0] < 2000
    report = layout.compact(spark, f"{tmp_path}/hot", f"{tmp_path}/packed", ["a", "b"], target_bytes=20_000).first()
    assert report["files"] >= 5
    assert layout.z_bits(1, 2) == 4 and layout.z_bits(100_000, 2) * 2 > 17


def test_packing_again_does_nothing(spark, tmp_path):
    """Rows that take far fewer bytes in files than in a shuffle still end in as few files as their bytes need."""
    path = f"{tmp_path}/t"
    rows = spark.range(200_000).select((F.xxhash64("id") % 8).alias("v"), (F.col("id") % 2).cast("int").alias("p"))
    V.publish(rows, path, "create", part=F.col("p"))
    crowded = spark.read.parquet(f"{path}/data/version=0/__bucket=0")
    many = crowded.repartition(8).localCheckpoint()
    many.write.mode("append").parquet(f"{path}/data/version=0/__bucket=0")
    target = int(1.2 * layout.stored_bytes(spark, f"{path}/data/version=0/__bucket=0"))
    assert V.pack(spark, path, target) == [0]
    assert len(V.as_of_version(spark, path, buckets=[0]).inputFiles()) == 1
    assert V.pack(spark, path, target) == [] and V.as_of_version(spark, path, buckets=[0]).count() == 200_000


def test_a_compacted_file_is_small_enough_for_its_task(spark, tmp_path, monkeypatch):
    spark.range(1000).selectExpr("id as a", "id % 7 as b").write.parquet(f"{tmp_path}/in")
    monkeypatch.setattr(layout, "stored_bytes", lambda *_: 1 << 30)
    assert layout.compact(spark, f"{tmp_path}/in", f"{tmp_path}/out", ["a", "b"]).first().files >= 8
