from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tradewind.operators.quality import DROP, FAIL, WARN, Rule, RuleFailed
from tradewind.plans import silver
from tradewind.sources import versions as V
from tradewind.streaming import flows, ingest


def write_csv(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def bronze_rows(spark, out):
    return spark.read.option("mergeSchema", True).parquet(str(out))


def test_csv_ingest_takes_each_file_once_and_rescues_misfits(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    args = (spark, str(src), "csv", str(out), str(ck), "orders*.csv")
    write_csv(src, "orders_1.csv", 'id,price,note\n1,2.5,plain\n2,3.5,"a, b"\n')
    write_csv(src, "other.csv", "x\n1\n")
    assert ingest.ingest_files(*args) == 2
    assert ingest.ingest_files(*args) == 0
    write_csv(src, "orders_2.csv", "note,id,price\nn,3,cheap\nm,4,1\n")  # other column order
    write_csv(src, "orders_3.csv", "id,price,note\n5,1.0,x,surplus\n")
    assert ingest.ingest_files(*args) == 3
    rows = {r.id: r for r in bronze_rows(spark, out).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert rows[2].note == "a, b" and rows[2]._rescued_data is None
    assert rows[3].price is None and rows[3]._rescued_data == '{"price":"cheap"}'
    assert rows[4].price == 1.0 and rows[4].note == "m"
    assert "surplus" in rows[5]._rescued_data and rows[5].price == 1.0
    assert rows[1]._source_file.endswith("orders_1.csv") and rows[1]._ingestion_timestamp


def test_csv_ingest_new_column_fails_once_then_is_taken_in(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    args = (spark, str(src), "csv", str(out), str(ck))
    write_csv(src, "a.csv", "id,price\n1,2.5\n")
    assert ingest.ingest_files(*args) == 1
    write_csv(src, "b.csv", "id,extra,price\n2,9,3.5\n")
    with pytest.raises(Exception, match="extra"):
        ingest.ingest_files(*args)
    assert bronze_rows(spark, out).count() == 1
    assert ingest.ingest_files(*args) == 1
    got = {(r.id, r.price, r.extra) for r in bronze_rows(spark, out).collect()}
    assert got == {(1, 2.5, None), (2, 3.5, 9)}


def test_csv_ingest_multiline_text_and_partition_folders(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    write_csv(src / "year=2017", "r.csv", 'id,message\n1,"two\nlines"\n')
    write_csv(src / "year=2018", "r.csv", 'id,message\n2,"say ""hi"""\n')
    assert ingest.ingest_files(spark, str(src), "csv", str(out), str(ck), multiline=True) == 2
    got = {(r.id, r.message, r.year) for r in bronze_rows(spark, out).collect()}
    assert got == {(1, "two\nlines", 2017), (2, 'say "hi"', 2018)}


def test_parquet_ingest_replay_extension_and_new_column(spark, tmp_path):
    src, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    args = (spark, str(src), "parquet", str(out), str(ck))
    spark.createDataFrame([(1, "a")], "id int, v string").write.parquet(f"{src}/year=2016")
    assert ingest.ingest_files(*args) == 1
    assert ingest.ingest_files(*args) == 0
    spark.createDataFrame([(2, "b"), (3, "c")], "id int, v string").write.parquet(f"{src}/year=2018")
    assert ingest.ingest_files(*args) == 2
    spark.createDataFrame([(4, "d", 1)], "id int, v string, w int").write.parquet(f"{src}/year=2019")
    with pytest.raises(ingest.SchemaWidened, match="w"):
        ingest.ingest_files(*args)
    assert ingest.ingest_files(*args) == 1
    got = {(r.id, r.v, r.year, r.w) for r in bronze_rows(spark, out).collect()}
    assert got == {(1, "a", 2016, None), (2, "b", 2018, None), (3, "c", 2018, None), (4, "d", 2019, 1)}


ORDER = ("order_id string, customer_id string, order_status string, "
         "order_purchase_timestamp string, order_approved_at string, "
         "order_delivered_carrier_date string, order_delivered_customer_date string, "
         "order_estimated_delivery_date string")


def order(oid, customer, status, bought="2017-01-05 10:00:00", delivered=None, due="2017-01-20 00:00:00"):
    return (oid, customer, status, bought, None, None, delivered, due)


class Dated:
    """Dated order files, ingested and applied."""

    def __init__(self, spark, root, scd_type):
        self.spark, self.root, self.scd_type = spark, root, scd_type
        self.spec = silver.change_tables()["dated_orders"]
        self.target = f"{root}/target"

    def land(self, day, rows):
        year, month, d = day.split("-")
        self.spark.createDataFrame(rows, ORDER).write.mode("append").parquet(
            f"{self.root}/in/year={year}/month={month}/day={d}")

    def run(self, **options):
        ingest.ingest_files(self.spark, f"{self.root}/in", "parquet", f"{self.root}/bronze",
                            f"{self.root}/ck_bronze")
        flows.change_flow(self.spark, f"{self.root}/bronze", silver.orders_staged, self.spec,
                          self.target, f"{self.root}/ck_silver", self.scd_type, buckets=4, **options)

    def rows(self):
        if self.scd_type == 1:
            return flows.read_type1(self.spark, self.target, self.spec.keys)
        return flows.read_type2(self.spark, self.target)


def test_scd1_flow_upserts_and_replays(spark, tmp_path):
    d = Dated(spark, tmp_path, 1)
    d.land("2016-01-01", [order("a", "c1", "created"), order("b", "c2", "shipped"),
                          order("x", None, "created")])
    d.run()
    first = d.rows()
    assert {r.order_id: r.order_status for r in first.collect()} == {"a": "created", "b": "shipped"}
    versions = V.latest_version(spark, d.target)
    d.run()
    assert V.latest_version(spark, d.target) == versions
    d.land("2018-01-01", [order("a", "c1", None), order("n", "c3", "approved"),
                          order("a", "c1", "delivered", delivered="2017-01-12 09:00:00")])
    d.run()
    got = {r.order_id: r for r in d.rows().collect()}
    assert set(got) == {"a", "b", "n"}
    assert (got["a"].order_status, got["a"].delivery_days, got["a"].is_on_time) == ("delivered", 7, True)
    assert got["b"].order_status == "shipped" and got["b"].is_on_time is None
    assert first.count() == 2  # an earlier reader keeps its files


def test_scd2_flow_keeps_versions_of_corrected_orders(spark, tmp_path):
    d = Dated(spark, tmp_path, 2)
    d.land("2017-01-05", [order("a", "c1", "created"), order("b", "c2", "created")])
    d.run()
    d.land("2017-01-07", [order("a", "c1", "delivered", bought="2017-01-07 10:00:00",
                                delivered="2017-01-12 09:00:00")])
    d.land("2017-01-06", [order("b", "c2", None, bought="2017-01-06 10:00:00")])
    d.run()
    d.run()
    got = sorted((r["order_id"], r["order_status"], str(r["__START_AT"]), str(r["__END_AT"]))
                 for r in d.rows().collect())
    assert [g[:2] for g in got if g[0] == "a"] == [("a", "created"), ("a", "delivered")]
    assert got[0][3] == "2017-01-07 10:00:00" and got[1][3] == "None"


def test_fail_rule_leaves_target_and_checkpoint_alone(spark, tmp_path):
    d = Dated(spark, tmp_path, 1)
    d.land("2016-01-01", [order("a", "c1", "created")])
    d.run()
    d.land("2016-01-02", [order(None, "c1", "created"), order("z", "c1", "created")])
    with pytest.raises(Exception, match="order_id_not_null"):
        d.run()
    assert [r.order_id for r in d.rows().collect()] == ["a"]
    with pytest.raises(Exception, match="order_id_not_null"):
        d.run()
    assert V.latest_version(spark, d.target) == 0


@pytest.mark.parametrize("scd_type", [1, 2])
def test_flow_result_does_not_depend_on_batches(spark, tmp_path, scd_type):
    rows = [order(o, "c", s, f"2017-01-0{n} 00:00:00") for n, o, s in [
        (3, "a", "shipped"), (1, "a", "created"), (2, "b", "created"), (5, "a", None),
        (4, "b", "approved"), (6, "a", "created"), (2, "a", "approved")]]
    results = []
    for name, parts in (("one", [rows]), ("many", [[r] for r in rows])):
        d = Dated(spark, tmp_path / name, scd_type)
        for part in parts:
            d.land("2017-01-01", part)
            d.run()
        plain = d.rows().drop("_ingestion_timestamp", "_source_file")
        results.append(sorted(map(repr, plain.select(sorted(plain.columns)).collect())))
    assert results[0] == results[1]


def test_append_flow_drops_and_counts(spark, tmp_path):
    spark.createDataFrame([("1", 3), (None, 4), ("2", 9)], "k string, s int").write.parquet(f"{tmp_path}/b")
    rules = [Rule("key", F.col("k").isNotNull(), DROP), Rule("score", F.col("s") <= 5, WARN)]
    rows = flows.stream_of(spark, f"{tmp_path}/b")
    counts = flows.append_flow(rows, rules, f"{tmp_path}/o", f"{tmp_path}/ck")
    assert counts == {"key": 1, "score": 1}
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/o").collect()) == ["1", "2"]
    fail = [Rule("k", F.col("k").isNotNull(), FAIL)]
    with pytest.raises(Exception, match="violated"):
        flows.append_flow(rows, fail, f"{tmp_path}/o2", f"{tmp_path}/ck2")
    assert not (tmp_path / "o2").exists()  # the batch is tried again, and stays undone, until the rows are mended
    drop = [Rule("k", F.col("k").isNotNull(), DROP)]
    assert flows.append_flow(rows, drop, f"{tmp_path}/o2", f"{tmp_path}/ck2", rejects_dir=f"{tmp_path}/r2")["k"] == 1
    assert spark.read.parquet(f"{tmp_path}/r2").first()["_rejected_by"] == ["k"]


def test_stream_joins_a_plain_lookup(spark, tmp_path):
    spark.createDataFrame([("p1", "brinquedos", "5"), ("p2", None, "x")],
                          "product_id string, product_category_name string, product_weight_g string") \
        .selectExpr("*", "'1' product_name_lenght", "'2' product_description_lenght",
                    "'3' product_photos_qty", "'4' product_length_cm", "'5' product_height_cm",
                    "'6' product_width_cm").write.parquet(f"{tmp_path}/b")
    english = spark.createDataFrame([("brinquedos", "toys")],
                                    "product_category_name string, product_category_name_english string")
    staged = silver.products_staged(flows.stream_of(spark, f"{tmp_path}/b"), english)
    flows.append_flow(staged, [], f"{tmp_path}/o", f"{tmp_path}/ck")
    got = {(r.product_id, r.product_category_name_english, r.product_weight_g)
           for r in spark.read.parquet(f"{tmp_path}/o").collect()}
    assert got == {("p1", "toys", 5.0), ("p2", None, None)}
