"""A, L and the stored or streamed forms of I, J and N.

Each query writes its tables to new folders below the shared scratch folder.
"""

import os
import re
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.checks.changes import INCREMENT_SQL
from tradewind.checks.marts import SLV_ORDERS_SQL, naive
from tradewind.checks.registry import ORACLE, query
from tradewind.functions import columns as X
from tradewind.operators import changes as C
from tradewind.operators.quality import DROP, FAIL, WARN, Rule
from tradewind.plans import build, gold, silver
from tradewind.session import STORED_CODEC, scratch
from tradewind.sources import growing, landing, layout, tables
from tradewind.sources import versions as V
from tradewind.streaming import flows, ingest

EVENTS_SQL = "select event_id, ts, user_id, event_type, value from events"


class Feed:
    """A source folder that files arrive in, and its bronze table."""

    def __init__(self, spark, fmt="parquet", **options):
        self.spark, self.fmt, self.options = spark, fmt, options
        self.root = scratch(spark, "feed")
        self.source, self.bronze = f"{self.root}/source", f"{self.root}/bronze"

    def land(self, df: DataFrame, *partition_by: str) -> None:
        if partition_by:  # few files per folder
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode("append").partitionBy(*partition_by)
        if self.fmt == "csv":
            writer.options(header=True, escape='"', ignoreLeadingWhiteSpace=False,
                           ignoreTrailingWhiteSpace=False, emptyValue='""').csv(self.source)
        else:
            writer.parquet(self.source, compression=STORED_CODEC)

    def ingest(self) -> int:
        return ingest.ingest_files(self.spark, self.source, self.fmt, self.bronze,
                                   f"{self.root}/checkpoint_bronze", **self.options)

    def rows(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(self.bronze)


def dated(df: DataFrame, ts) -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.day(ts)})


def events(t) -> DataFrame:
    return t.raw("events").select("event_id", "ts", "user_id", "event_type", "value")


# --- A sources -----------------------------------------------------------------

def landed_tables(t) -> dict[str, DataFrame]:
    return {"orders": t.landed_orders, "order_items": t.landed_order_items,
            "order_payments": t.landed_order_payments, "order_reviews": t.landed_order_reviews,
            "customers": t.landed_customers, "products": t.landed_products,
            "sellers": t.landed_sellers, "translation": t.translation}


def ingest_given(t, name: str) -> tuple[DataFrame, int]:
    """Streams one of the given parquet tables into a bronze table."""
    root = scratch(t.spark, "ingest")
    n = ingest.ingest_files(t.spark, t.folder, "parquet", f"{root}/bronze", f"{root}/checkpoint",
                            glob=f"{name}.parquet")
    return t.spark.read.parquet(f"{root}/bronze"), n


@query("a1_ingest_parquet", EVENTS_SQL)
def _(t):
    return ingest_given(t, "events")[0].select("event_id", "ts", "user_id", "event_type", "value")


@query("a2_ingest_csv", "select event_id, user_id, event_type, value, props from events")
def _(t):
    feed = Feed(t.spark, "csv", glob="*.csv")
    rows = t.raw("events").select("event_id", "user_id", "event_type", "value", "props")
    feed.land(rows.filter("event_type <> 'view'"))
    feed.ingest()
    feed.land(rows.filter("event_type = 'view'"))
    feed.ingest()
    return feed.rows().select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                for f in rows.schema])


@query("a3_ingest_multiline_csv", "select doc_id, lang, length(text) as n from documents")
def _(t):
    """Whole multi-line texts travel through CSV files."""
    feed = Feed(t.spark, "csv", glob="*.csv", multiline=True)
    feed.land(t.raw("documents").select("doc_id", "lang", "text"))
    feed.ingest()
    return feed.rows().select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang",
                              F.length("text").cast("bigint").alias("n"))


@query("a4_source_file", "select 'events.parquet' as file, count(*) as n from events")
def _(t):
    rows, _ = ingest_given(t, "events")
    return rows.groupBy(F.substring_index(silver.SOURCE, "/", -1).alias("file")).agg(
        X.rows().alias("n"))


@query("a5_ingestion_time", "select count(*) as n, 1::bigint as stamps, true as recent from orders")
def _(t):
    rows, _ = ingest_given(t, "orders")
    stamp = F.col(silver.INGESTED)
    return rows.agg(X.rows().alias("n"), F.countDistinct(stamp).alias("stamps"),
                    F.every(stamp <= F.current_timestamp()).alias("recent"))


@query("a6_schema_evolution", """
    select event_id, case when event_type <> 'view' then value end as value from events""")
def _(t):
    """Views arrive before the value column exists; the next run fails once, then goes on."""
    feed = Feed(t.spark)
    feed.land(events(t).filter("event_type = 'view'").drop("value"))
    feed.ingest()
    feed.land(events(t).filter("event_type <> 'view'"))
    try:
        feed.ingest()
    except ingest.SchemaWidened:
        feed.ingest()
    return feed.rows().select("event_id", "value")


@query("a7_rescued_data", """
    select cast(order_id as varchar) as order_id,
           case when order_id % 11 <> 0 then review_score end as review_score,
           case when order_id % 11 = 0 then '{"review_score":"n/a"}' end as _rescued_data
    from s_order_reviews""")
def _(t):
    schema = T.StructType.fromDDL("order_id string, review_score int, "
                                  "review_answer_timestamp timestamp")
    texts = t.landed_order_reviews.select(*schema.names)
    return landing.rescue_cast(texts, schema).drop("review_answer_timestamp")


@query("a7_mixed_parquet_types", """
    select event_id, case when event_type <> 'view' or event_id % 3 <> 0 then user_id end as user_id,
           case when event_type = 'view' and event_id % 3 = 0 then '{"user_id":"user ' || user_id || '"}' end as _rescued_data
    from events""")
def _(t):
    """Views deliver the user as text, a third of them unreadable, other events as a number."""
    feed = Feed(t.spark, mixed_types=True)
    rows = events(t).select("event_id", "user_id", "event_type")
    feed.land(rows.filter("event_type <> 'view'").drop("event_type"))
    feed.ingest()
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("user "), "user_id")).otherwise(F.col("user_id").cast("string"))
    feed.land(rows.filter("event_type = 'view'").withColumn("user_id", text).drop("event_type"))
    feed.ingest()
    return feed.rows().select("event_id", "user_id", "_rescued_data")


@query("a8_partition_discovery", """
    select cast(year(ts) as int) as year, cast(month(ts) as int) as month,
           cast(day(ts) as int) as day, count(*) as n from events group by all""")
def _(t):
    feed = Feed(t.spark)
    feed.land(dated(events(t), "ts"), "year", "month", "day")
    feed.ingest()
    return feed.rows().groupBy("year", "month", "day").agg(X.rows().alias("n"))


@query("a9_each_file_once", """
    select 1 as run, count(*) as n from events where event_type <> 'view'
    union all select 2, 0
    union all select 3, count(*) from events where event_type = 'view'""")
def _(t):
    """One file per batch, and more batches than a stream keeps progress reports of."""
    window = "spark.sql.streaming.numRecentProgressUpdates"
    before = t.spark.conf.get(window)
    t.spark.conf.set(window, "3")
    try:
        feed = Feed(t.spark, files_per_batch=1)
        feed.land(events(t).filter("event_type <> 'view'").repartition(6))
        counts = [feed.ingest(), feed.ingest()]
        feed.land(events(t).filter("event_type = 'view'").repartition(5))
        counts.append(feed.ingest())
    finally:
        t.spark.conf.set(window, before)
    return t.spark.createDataFrame(list(enumerate(counts, 1)), "run int, n bigint")


@query("a10_tables_by_name", """
    select product_category_name, cast(sum(price) as double) as revenue
    from s_order_items join s_products using (product_id) group by all""")
def _(t):
    tables.publish_views(t.spark, {"order_items": t.order_items, "products": t.products},
                         prefix="tradewind_")
    return t.spark.sql("""
        select product_category_name, cast(sum(price) as double) as revenue
        from tradewind_order_items join tradewind_products using (product_id)
        group by product_category_name""")


@query("a11_prepare_landing", """
    select 'orders' as "table", count(*) as rows from s_orders
    union all select 'order_items', count(*) from s_order_items
    union all select 'order_payments', count(*) from s_order_payments
    union all select 'order_reviews', count(*) from s_order_reviews
    union all select 'customers', count(*) from s_customers
    union all select 'products', count(*) from s_products
    union all select 'sellers', count(*) from s_sellers
    union all select 'translation', count(*) from s_translation
    union all select 'missing', 1""")
def _(t):
    """All eight tables, review texts over two lines; a delivery with a file missing writes nothing."""
    root = scratch(t.spark, "landing")
    frames = landed_tables(t)
    frames["order_reviews"] = frames["order_reviews"].withColumn(
        "review_comment_message", F.concat_ws("\n", "review_comment_title", "review_comment_message"))
    for name, df in frames.items():
        df.write.options(header=True, escape='"').csv(f"{root}/{name}_csv")
    files = {n: f"{root}/{n}_csv" for n in frames}
    try:
        landing.prepare_landing(t.spark, {**files, "geolocation": f"{root}/geolocation_csv"}, f"{root}/early")
        missing = 0
    except landing.MissingFiles as error:
        missing = len(str(error).split(", "))
    landed = landing.prepare_landing(t.spark, files, f"{root}/landed")
    return landed.unionByName(t.spark.createDataFrame([("missing", missing)], '`table` string, rows bigint'))


@query("a12_typed_scan", """
    select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as int) as l_linenumber,
           cast(l_extendedprice as double) as l_extendedprice from lineitem""")
def _(t):
    schema = T.StructType([T.StructField("l_orderkey", T.StringType(), True),
                           T.StructField("l_linenumber", T.IntegerType(), True),
                           T.StructField("l_extendedprice", T.DoubleType(), True)])
    return landing.typed_scan(t.spark, os.path.join(t.folder, "lineitem.parquet"), schema)


@query("a13_inline_rows", """
    select order_id, customer_id, case when order_id = 0 then 'canceled' else order_status end
               as order_status from s_orders
    union all select -1, null, 'processing'""")
def _(t):
    """Two hand-written changes are merged into the orders: one known, one new."""
    target = t.orders_placed.select("order_id", "customer_id", "order_status")
    rows = tables.inline_rows(t.spark, [(0, None, "canceled"), (-1, None, "processing")],
                              "order_id bigint, customer_id bigint, order_status string",
                              view="tradewind_order_updates")
    return C.merge(target, rows, ["order_id"], update_cols=["order_status"])


@query("a14_seed", """
    select region, count(*) as customers from s_customers
           left join s_regions on state = customer_state group by region""")
def _(t):
    path = scratch(t.spark, "seed")
    t.regions.coalesce(1).write.option("header", True).csv(path)
    seed = landing.load_seed(t.spark, path, "state string, region string")
    located = t.customers.groupBy("customer_state").agg(X.rows().alias("n"))
    return (located.join(seed, located["customer_state"] == seed["state"], "left")
            .groupBy("region").agg(F.sum("n").alias("customers")))


@query("a15_batch_read_of_streamed_table", """
    select event_type, count(*) as n from events group by event_type""")
def _(t):
    return ingest_given(t, "events")[0].groupBy("event_type").agg(X.rows().alias("n"))


@query("a16_append_sink", "select event_id, user_id from events where event_type <> 'error'")
def _(t):
    feed = Feed(t.spark)
    feed.land(events(t))
    feed.ingest()
    rows = flows.stream_of(t.spark, feed.bronze).filter("event_type <> 'error'")
    flows.append_flow(rows.select("event_id", "user_id"), [], f"{feed.root}/silver",
                      f"{feed.root}/checkpoint_silver")
    return t.spark.read.parquet(f"{feed.root}/silver")


@query("a17_full_refresh", """
    select order_status, count(*) as n from s_orders group by order_status""")
def _(t):
    counts = t.orders_placed.groupBy("order_status").agg(X.rows().alias("n"))
    return tables.full_refresh(counts, scratch(t.spark, "refresh"))


@query("a18_create_table_as", "select order_id, order_status from s_orders")
def _(t):
    return tables.create_table_as(t.orders_placed.select("order_id", "order_status"),
                                  "tradewind_orders_copy", scratch(t.spark, "ctas"))


@query("a19_layers", """
    select 'fct_orders' as name, count(*) as n from s_orders
    union all select 'dim_customers', count(distinct customer_id) from s_orders
    union all select 'dim_products', count(*) from s_products
    union all select 'revenue_by_category', count(distinct (category, date_trunc('month', order_purchase_ts)))
    from s_order_items join s_orders using (order_id) join m_labels using (product_id)
    where order_status = 'delivered'""")
def _(t):
    """The star is built in layers, each behind its tests, over stored orders and reviews; line numbers that repeat in an order are counted on."""
    ordered = Window.partitionBy("order_id")
    sources = t.tables()
    sources["order_items"] = sources["order_items"].withColumn("order_item_id", F.row_number().over(
        ordered.orderBy("order_item_id", "product_id", "seller_id", "price")))
    sources["order_payments"] = sources["order_payments"].withColumn("payment_sequential", F.row_number().over(
        ordered.orderBy("payment_sequential", "payment_type", "payment_value")))
    sources["order_reviews"] = sources["order_reviews"].join(t.orders_placed.select("order_id"), "order_id", "left_semi")
    root = scratch(t.spark, "layers")
    for name in ("orders", "order_reviews"):  # joins that several tests and layers read
        sources[name] = tables.full_refresh(sources[name], f"{root}/sources/{name}")
    built = build.build_star(t.spark, sources, root)
    counts = [built[n].agg(X.rows().alias("n")).select(F.lit(n).alias("name"), "n")
              for n in ("fct_orders", "dim_customers", "dim_products", "revenue_by_category")]
    return reduce(DataFrame.unionByName, counts)


@query("a20_partitioned_by_month", """
    select order_id, order_purchase_ts from s_orders
    where strftime(order_purchase_ts, '%Y-%m') = '1998-01'""")
def _(t):
    path = scratch(t.spark, "by_month")
    layout.write_by_month(t.orders_placed, "order_purchase_ts", path)
    month = t.spark.read.parquet(path).filter(F.col("purchase_month") == "1998-01")
    return month.select("order_id", "order_purchase_ts")


ITEMS_SQL = "select order_id, order_item_id, product_id, seller_id from s_order_items"


@query("a21_clustered", ITEMS_SQL)
def _(t):
    """Clustered by seller and product, then clustered anew by order."""
    first, second = scratch(t.spark, "clustered"), scratch(t.spark, "clustered")
    layout.write_clustered(t.order_items, first, ["seller_id", "product_id"])
    layout.write_clustered(t.spark.read.parquet(first), second, ["order_id"])
    return t.spark.read.parquet(second).select("order_id", "order_item_id", "product_id",
                                               "seller_id")


@query("a22_compacted", ITEMS_SQL)
def _(t):
    small, packed = scratch(t.spark, "small"), scratch(t.spark, "packed")
    t.order_items.repartition(16).write.parquet(small)
    layout.compact(t.spark, small, packed, zorder_by=["product_id", "seller_id"])
    return t.spark.read.parquet(packed).select("order_id", "order_item_id", "product_id",
                                               "seller_id")


@query("a22_packed_parts", """
    select order_id, order_item_id, product_id, seller_id, true as others_kept from s_order_items""")
def _(t):
    """Parts with several small files are packed; those with one keep theirs."""
    path = scratch(t.spark, "packed-parts")
    rows = t.order_items.select("order_id", "order_item_id", "product_id", "seller_id")
    part = F.pmod("seller_id", F.lit(4))
    V.publish(rows, path, "create", part=part)
    V.pack(t.spark, path)  # a large table is written in several files a part
    first = V.newest(t.spark, path).placed
    for k in (0, 1):  # two parts come in many files
        held = V.as_of_version(t.spark, path, buckets=[k])
        many = 6 * len(held.inputFiles())
        crowded = held.repartition(many)
        folder = f"{path}/data/version={first[k]}/{V.BUCKET}={k}"
        crowded.write.parquet(f"{path}/crowded-{k}")
        t.spark.read.parquet(f"{path}/crowded-{k}").repartition(many).write.mode("overwrite").parquet(folder)
    packed = V.pack(t.spark, path)
    placed = V.newest(t.spark, path).placed
    kept = packed == [0, 1] and all(placed[k] == first[k] for k in (2, 3)) and all(placed[k] > first[k] for k in packed)
    return V.as_of_version(t.spark, path).withColumn("others_kept", F.lit(kept))


# --- L partitioning and caching ---------------------------------------------------

@query("l1_cached_two_actions", """
    select count(*) as n, cast(sum(price) as double) as revenue from s_order_items""")
def _(t):
    prices = t.order_items.select("price").persist()
    try:
        n = prices.count()
        revenue = prices.agg(X.amount(F.sum("price"))).first()[0]
    finally:
        prices.unpersist()
    return t.spark.createDataFrame([(n, revenue)], "n bigint, revenue double")


@query("l2_repartitioned", """
    select count(*) as n, true as at_most_four, 0::bigint as split_sellers from s_order_items""")
def _(t):
    placed = t.order_items.repartition(4, "seller_id").select(
        "seller_id", F.spark_partition_id().alias("p"))
    per_seller = placed.groupBy("seller_id", "p").agg(X.rows().alias("n"))
    spread = per_seller.groupBy("seller_id").agg(
        F.sum("n").alias("n"), X.rows().alias("places"), F.max("p").alias("p"))
    return spread.agg(F.sum("n").alias("n"), (F.countDistinct("p") <= 4).alias("at_most_four"),
                      F.count_if(F.col("places") > 1).alias("split_sellers"))


@query("l3_coalesced", "select count(*) as n, true as at_most_two from s_order_items")
def _(t):
    placed = t.order_items.repartition(8).coalesce(2).select(F.spark_partition_id().alias("p"))
    return placed.agg(X.rows().alias("n"), (F.countDistinct("p") <= 2).alias("at_most_two"))


# --- I, N streamed silver -----------------------------------------------------------

def flow_result(t, landed: DataFrame, table: str, stage) -> DataFrame:
    feed = Feed(t.spark)
    feed.land(landed)
    feed.ingest()
    spec = silver.change_tables()[table]
    target = f"{feed.root}/silver"
    flows.change_flow(t.spark, feed.bronze, stage, spec, target,
                      f"{feed.root}/checkpoint_silver", buckets=4)
    return flows.read_type1(t.spark, target, spec.keys).drop(silver.SOURCE, silver.INGESTED)


@query("i1_stream_typed_projection", """
    select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id,
           order_status, order_purchase_ts, order_purchase_ts as approved_at,
           estimated_delivery_at as estimated_delivery_ts, delivered_at from s_orders""")
def _(t):
    feed = Feed(t.spark)
    feed.land(t.landed_orders)
    feed.ingest()
    rows = silver.orders_typed(flows.stream_of(t.spark, feed.bronze))
    flows.append_flow(rows, silver.append_rules()["orders"], f"{feed.root}/silver",
                      f"{feed.root}/checkpoint_silver")
    return naive(t.spark.read.parquet(f"{feed.root}/silver"))


@query("i2_change_flow_customers", """
    select cast(customer_id as varchar) as customer_id,
           cast(customer_unique_id as varchar) as customer_unique_id,
           cast(customer_id % 1000 as varchar) as customer_zip_code_prefix,
           upper(customer_city) as customer_city, upper(customer_state) as customer_state
    from s_customers""")
def _(t):
    return flow_result(t, t.landed_customers, "customers", silver.customers_staged)


@query("i5_scd2_flow", "select * from m_versions")
def _(t):
    """Dated event files arrive in two parts; versions grow with the second."""
    feed = Feed(t.spark)
    spec = silver.ChangeTable(["user_id"], [], ["user_id"], sequence_by="ts",
                              track_except=["value", silver.SOURCE, silver.INGESTED,
                                            "year", "month", "day"])
    target = f"{feed.root}/silver"
    rows = dated(t.changes, "ts")
    for part in (F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"),
                 F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")):
        feed.land(rows.filter(part), "year", "month", "day")
        feed.ingest()
        flows.change_flow(t.spark, feed.bronze, lambda df: df, spec, target,
                          f"{feed.root}/checkpoint_silver", scd_type=2, buckets=4)
    return flows.read_type2(t.spark, target).select(
        "user_id", "ts", "event_type", "value", C.START, C.END)


@query("c10_stream_static_join", """
    select cast(product_id as varchar) as product_id, product_category_name,
           product_category_name_english, cast(product_weight_g as double) as product_weight_g
    from m_labels""")
def _(t):
    return flow_result(t, t.landed_products, "products", lambda df: silver.products_staged(
        df, t.translation)).select("product_id", "product_category_name",
                                   "product_category_name_english", "product_weight_g")


@query("i10_gold_reads_changed_table_as_batch", """
    select strftime(order_purchase_ts, '%Y-%m') as order_month, count(*) as order_count,
           count(*) filter (where delivered_at > estimated_delivery_at) as late_delivery_count
    from s_orders group by 1""")
def _(t):
    orders = flow_result(t, t.landed_orders, "orders", silver.orders_staged)
    return gold.monthly_delivery(orders).select("order_month", "order_count",
                                                "late_delivery_count")


@query("n15_bronze_tables", """
    select 'orders' as "table", count(*) as n from s_orders
    union all select 'order_items', count(*) from s_order_items
    union all select 'order_payments', count(*) from s_order_payments
    union all select 'order_reviews', count(*) from s_order_reviews
    union all select 'customers', count(*) from s_customers
    union all select 'products', count(*) from s_products
    union all select 'sellers', count(*) from s_sellers
    union all select 'translation', count(*) from s_translation""")
def _(t):
    landed = landed_tables(t)
    counts = []
    for name, df in landed.items():
        feed = Feed(t.spark)
        feed.land(df)
        feed.ingest()
        counts.append(feed.rows().agg(X.rows().alias("n")).select(
            F.lit(name).alias("table"), "n"))
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result


def dated_orders(t, scd_type: int) -> DataFrame:
    """Orders arrive as created, then once more as they are: a correction in later files."""
    feed = Feed(t.spark)
    spec = silver.change_tables()["dated_orders"]
    target = f"{feed.root}/silver"
    final = dated(t.landed_orders, F.to_date("order_purchase_timestamp"))
    created = final.withColumns({"order_status": F.lit("created"), **{
        c: F.lit(None).cast("string") for c in ("order_delivered_carrier_date",
                                                "order_delivered_customer_date")}})
    for rows in (created, final, None):
        if rows is not None:
            feed.land(rows, "year", "month")
        feed.ingest()
        flows.change_flow(t.spark, feed.bronze, silver.orders_staged, spec, target,
                          f"{feed.root}/checkpoint_silver", scd_type, buckets=4)
    rows = (flows.read_type1(t.spark, target, spec.keys) if scd_type == 1
            else flows.read_type2(t.spark, target))
    return naive(rows.drop(silver.SOURCE, silver.INGESTED))


DATED_SQL = f"""
    select *, cast(year(order_purchase_timestamp) as int) as year,
           cast(month(order_purchase_timestamp) as int) as month,
           cast(day(order_purchase_timestamp) as int) as day from ({SLV_ORDERS_SQL})"""


@query("n23_dated_orders_scd1", DATED_SQL)
def _(t):
    return dated_orders(t, 1)


@query("n24_dated_orders_scd2", f"""
    select *, order_purchase_timestamp as "__START_AT", cast(null as timestamp) as "__END_AT"
    from ({DATED_SQL})""")
def _(t):
    """The sequence is the purchase time, which a correction repeats: one version each."""
    return dated_orders(t, 2)


# --- J2, J3 as stored tables ------------------------------------------------------------

def grown_fact(t) -> str:
    """Orders before 2000, then a run that is given all of them and takes the newer ones."""
    path = scratch(t.spark, "grown")
    orders = t.orders_placed.select("order_id", "customer_id", "order_purchase_ts")
    loaded = orders.filter(F.col("order_purchase_ts") < F.lit("2000-01-01").cast("timestamp_ntz"))
    for rows, origin in ((loaded, "loaded"), (orders, "new")):
        growing.grow_by_month(t.spark, rows.withColumn("origin", F.lit(origin)), path, ["order_id"], "order_purchase_ts")
    return path


@query("j2_stored_fact", INCREMENT_SQL)
def _(t):
    return V.as_of_version(t.spark, grown_fact(t))


@query("j2_months_written", """
    with newest as (select max(order_purchase_ts) as latest from s_orders where order_purchase_ts < timestamp '2000-01-01')
    select 12 * year(order_purchase_ts) + month(order_purchase_ts) - 1 as month,
           max((order_purchase_ts > latest)::int) as version
    from s_orders, newest group by 1""")
def _(t):
    """The run that wrote each month's files: months without new orders keep theirs."""
    placed = V.newest(t.spark, grown_fact(t)).placed
    return t.spark.createDataFrame(sorted(placed.items()), "month bigint, version int")


def stored_snapshot(t) -> str:
    """Three runs over the customers' segments: as they are, some turned gold, and gold turned back."""
    path = scratch(t.spark, "snapshot")
    base = t.raw("customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), "c_acctbal", "c_nationkey")
    gold_now = F.when(F.col("c_acctbal") > 5000, "GOLD").otherwise(F.col("segment"))
    runs = (base.filter("c_nationkey <> 3"), base.withColumn("segment", gold_now), base.filter("c_nationkey <> 4"))
    for n, rows in enumerate(runs, 1):
        growing.grow_snapshot(t.spark, rows.select("c_custkey", "segment"), path, ["c_custkey"], ["segment"],
                              F.lit(f"2024-0{n}-01").cast("timestamp_ntz"), rows_per_bucket=100)
    return path


@query("j3_stored_snapshot", """
    with rows as (
        select c_custkey, c_mktsegment as plain, case when c_acctbal > 5000 then 'GOLD' else c_mktsegment end as gold,
               c_nationkey = 3 as late, c_nationkey = 4 as gone from customer)
    select c_custkey, plain as segment, timestamp '2024-01-01' as valid_from,
           case when gold <> plain then timestamp '2024-02-01' end as valid_to from rows where not late
    union all
    select c_custkey, gold, timestamp '2024-02-01',
           case when gold <> plain and not gone then timestamp '2024-03-01' end from rows where late or gold <> plain
    union all
    select c_custkey, plain, timestamp '2024-03-01', null from rows where gold <> plain and not gone""")
def _(t):
    return V.as_of_version(t.spark, stored_snapshot(t))


@query("n43_stored_snapshot", """
    select order_id, 'shipped' as order_status, order_purchase_ts, timestamp '2024-01-01' as valid_from,
           case when order_status <> 'shipped' then timestamp '2024-01-02' end as valid_to from s_orders
    union all
    select order_id, order_status, order_purchase_ts, timestamp '2024-01-02', null from s_orders
    where order_status <> 'shipped'""")
def _(t):
    path = scratch(t.spark, "snapshot")
    now = t.orders_placed.select("order_id", "order_status", F.col("order_purchase_ts").alias("order_purchase_timestamp"))
    for n, rows in enumerate((now.withColumn("order_status", F.lit("shipped")), now), 1):
        history = build.take_snapshot(t.spark, rows, path, F.lit(f"2024-01-0{n}").cast("timestamp_ntz"))
    return history.withColumnRenamed("order_purchase_timestamp", "order_purchase_ts")


# --- J4 versioned tables ---------------------------------------------------------------

def versioned(t) -> str:
    """Version 0 without canceled orders; version 1 has them merged in."""
    path = scratch(t.spark, "versioned")
    base = t.orders_placed.select("order_id", "customer_id", "order_status")
    V.publish(base.filter("order_status <> 'canceled'").withColumn(
        "order_status", F.lit("created")), path, "create")
    merged = C.merge(V.as_of_version(t.spark, path), base.filter("order_status <> 'shipped'"),
                     ["order_id"], ["order_status"])
    V.publish(merged, path, "merge")
    return path


@query("j4_versions", """
    select 0 as version, 'create' as operation, count(*) filter (where
               order_status <> 'canceled') as rows from s_orders
    union all select 1, 'merge', count(*) from s_orders""")
def _(t):
    return V.versions(t.spark, versioned(t)).select("version", "operation", "rows")


@query("j4_as_of_version", """
    select order_id, customer_id, 'created' as order_status from s_orders
    where order_status <> 'canceled'""")
def _(t):
    return V.as_of_version(t.spark, versioned(t), 0)


@query("j4_version_diff", """
    select order_id, case order_status when 'canceled' then 'added' else 'changed' end as change
    from s_orders where order_status <> 'shipped'""")
def _(t):
    return V.version_diff(t.spark, versioned(t), 0, 1, ["order_id"])


@query("j4_restore", """
    select order_id, customer_id, 'created' as order_status from s_orders
    where order_status <> 'canceled'""")
def _(t):
    path = versioned(t)
    V.restore(t.spark, path, 0)
    return V.as_of_version(t.spark, path)


@query("j4_as_of_time", """
    select order_id, customer_id, 'created' as order_status from s_orders
    where order_status <> 'canceled'""")
def _(t):
    path = versioned(t)
    first = V.versions(t.spark, path).filter("version = 0").select(
        F.col("published_at").cast("string").alias("at")).first()["at"]
    return V.as_of_version(t.spark, path, moment=first)


@query("j4_restore_bucketed", "select customer_id, customer_city from s_customers")
def _(t):
    """Bucketed versions: all, then all under another city, then the first again and one more batch."""
    path = scratch(t.spark, "restored")
    rows = t.customers.select("customer_id", "customer_city")
    V.publish(rows, path, "create", ["customer_id"], 4)
    V.publish(rows.withColumn("customer_city", F.lit("elsewhere")), path, "move", ["customer_id"], 4)
    V.restore(t.spark, path, 0)
    part = V.as_of_version(t.spark, path, buckets=[1])
    V.publish(part, path, "touch", ["customer_id"], 4, touched=[1])
    V.rebucket(t.spark, path, 8)
    return V.as_of_version(t.spark, path)


def changes_in_parts(t, parts, scd_type: int = 2):
    """A feed whose event files arrive in parts; ``parts`` yields after each applied batch."""
    feed = Feed(t.spark)
    spec = silver.ChangeTable(["user_id"], [], ["user_id"], sequence_by="ts",
                              track_except=["value", silver.SOURCE, silver.INGESTED])
    target = f"{feed.root}/silver"
    for n, (rows, then) in enumerate(parts):
        feed.land(rows)
        feed.ingest()
        flows.change_flow(t.spark, feed.bronze, lambda df: df, spec, target,
                          f"{feed.root}/checkpoint_silver", scd_type, buckets=4 if n == 0 else None)
        if then is not None:
            then(target)
    return target


@query("j4_restore_scd2", "select * from m_versions")
def _(t):
    """Later changes are applied, taken back by a restore, and do not come back with the next batch."""
    half = F.lit("2024-01-10").cast("timestamp_ntz")
    wrong = t.changes.withColumn("event_type", F.lit("wrong")).withColumn("ts", F.col("ts") + F.expr("interval 1 second"))
    target = changes_in_parts(t, [
        (t.changes.filter(F.col("ts") < half), None),
        (wrong, lambda path: V.restore(t.spark, path, 0)),
        (t.changes.filter(F.col("ts") >= half), None)])
    return flows.read_type2(t.spark, target).select("user_id", "ts", "event_type", "value", C.START, C.END)


@query("k1_flow_rule_counts", """
    select 'has_customer' as rule, 'drop' as action, count(*) filter (where customer_id % 7 = 0) as violations
    from s_orders
    union all select 'is_final', 'warn', count(*) filter (
        where order_status <> 'delivered' and customer_id % 7 <> 0) from s_orders""")
def _(t):
    """What the rules of a change flow found, batch by batch, stays with the table."""
    feed = Feed(t.spark)
    landed = t.orders_placed.select("order_id", "order_status", "order_purchase_ts", F.when(
        F.col("customer_id") % 7 != 0, F.col("customer_id")).alias("customer_id"))
    spec = silver.ChangeTable(["order_id"], [
        Rule("has_customer", F.col("customer_id").isNotNull(), DROP),
        Rule("is_final", F.col("order_status") == "delivered", WARN)], ["order_id"],
        sequence_by="order_purchase_ts")
    target = f"{feed.root}/silver"
    for part in (F.col("order_id") % 2 == 0, F.col("order_id") % 2 == 1):
        feed.land(landed.filter(part))
        feed.ingest()
        flows.change_flow(t.spark, feed.bronze, lambda df: df, spec, target, f"{feed.root}/checkpoint_silver")
    return flows.rule_results(t.spark, target).groupBy("rule", "action").agg(
        F.sum("violations").alias("violations"))


CHANGE_RUNS: dict[tuple[str, str], tuple[str, dict[str, DataFrame]]] = {}


def change_layers(t) -> tuple[str, dict[str, DataFrame]]:
    """Files to bronze, bronze to silver through change flows, silver to gold, in one run a session.

    Of lines and reviews that repeat their key one is delivered, the last.
    """
    run = (t.spark.sparkContext.applicationId, t.folder)
    if run not in CHANGE_RUNS:
        CHANGE_RUNS[run] = _change_layers(t)
    return CHANGE_RUNS[run]


def _change_layers(t) -> tuple[str, dict[str, DataFrame]]:
    root = scratch(t.spark, "change-layers")
    landed = landed_tables(t)
    del landed["order_payments"]
    landed["reviews"] = C.scd1(landed.pop("order_reviews"), ["review_id"], "review_answer_timestamp")
    by = ["shipping_limit_date", "product_id", "price"]
    items = landed["order_items"].withColumn("by", F.struct(*by)).drop(*by)
    landed["order_items"] = C.scd1(items, ["order_id", "order_item_id"], "by").select("*", "by.*").drop("by")
    for name, df in landed.items():
        df.write.parquet(f"{root}/landing/{name}")
    built = build.run_change_layers(
        t.spark, {name: (f"{root}/landing/{name}", "parquet", None) for name in landed}, f"{root}/out")
    return f"{root}/out", built


LAST_ITEMS_SQL = """
    select * from s_order_items qualify row_number() over (partition by order_id, order_item_id order by
        strftime(shipping_limit_ts, '%Y-%m-%d %H:%M:%S') desc, product_id::varchar desc, price::varchar desc) = 1"""


@query("a19_change_layers", f"""
    with items as ({LAST_ITEMS_SQL}),
    last_reviews as (select * from s_order_reviews qualify row_number() over (
        partition by review_id order by review_answer_timestamp desc) = 1)
    select 'customers' as name, count(*) as n, sum(hash_of)::bigint as content from (
        select md5_number_lower(customer_id || '|' || upper(customer_city) || '|' || upper(customer_state)) % 1000003 as hash_of
        from s_customers)
    union all select 'order_items', count(*), sum(md5_number_lower(order_id || '|' || order_item_id || '|' || product_id || '|'
        || seller_id || '|' || (price * 100)::bigint) % 1000003)::bigint from items where price > 0
    union all select 'orders', count(*), sum(md5_number_lower(order_id || '|' || customer_id || '|' || order_status || '|'
        || strftime(order_purchase_ts, '%Y-%m-%d') || '|' || coalesce(strftime(delivered_at, '%Y-%m-%d'), '')) % 1000003)::bigint from s_orders
    union all select 'products', count(*), sum(md5_number_lower(product_id || '|' || coalesce(product_category_name, '') || '|'
        || coalesce(product_category_name_english, '') || '|' || product_weight_g::bigint) % 1000003)::bigint from m_labels
    union all select 'reviews', count(*), sum(md5_number_lower(review_id || '|' || order_id || '|' || review_score) % 1000003)::bigint
    from last_reviews where order_id % 11 <> 0
    union all select 'sellers', count(*), sum(md5_number_lower(seller_id || '|' || upper(seller_city) || '|' || upper(seller_state)) % 1000003)::bigint
    from s_sellers
    union all select 'order_items rejected', count(*), 0 from items where not price > 0""")
def _(t):
    """What every silver table holds, as a count and a checksum of its rows."""
    out, built = change_layers(t)
    day = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    whole = lambda c, by=1: F.round(F.col(c) * by).cast("bigint").cast("string")
    shown = {
        "customers": ["customer_id", "customer_city", "customer_state"],
        "order_items": ["order_id", "order_item_id", "product_id", "seller_id", whole("price", 100)],
        "orders": ["order_id", "customer_id", "order_status", day("order_purchase_timestamp"), day("order_delivered_customer_date")],
        "products": ["product_id", text("product_category_name"), text("product_category_name_english"), whole("product_weight_g")],
        "reviews": ["review_id", "order_id", "review_score"],
        "sellers": ["seller_id", "seller_city", "seller_state"]}
    parts = [built[name].agg(X.rows().alias("n"), F.sum(md5_remainder(F.concat_ws("|", *columns))).cast("bigint").alias("content"))
             .select(F.lit(name).alias("name"), "n", "content") for name, columns in shown.items()]
    rejected = flows.rule_results(t.spark, f"{out}/silver/order_items").filter("action = 'drop'").agg(
        F.max("violations").alias("n")).select(F.lit("order_items rejected").alias("name"), "n", F.lit(0).cast("bigint").alias("content"))
    return reduce(DataFrame.unionByName, [*parts, rejected])


def md5_remainder(text):
    """The low half of an MD5, read as DuckDB's md5_number_lower does, modulo a prime."""
    low = F.substring(F.md5(text), 17, 16)
    bytes_back = F.concat(*[F.substring(low, i, 2) for i in range(15, 0, -2)])
    return F.conv(bytes_back, 16, 10).cast("decimal(20,0)") % 1000003


@query("a19_change_gold", f"""
    with items as (select * from ({LAST_ITEMS_SQL}) where price > 0)
    select coalesce(l.product_category_name_english, 'uncategorized') as category,
           round(cast(sum(i.price + i.freight_value) as double), 2) as total_revenue,
           count(distinct i.order_id) as order_count, count(*) as item_count
    from items i join s_orders o on o.order_id = i.order_id
         left join m_labels l on l.product_id = i.product_id
    where o.order_status = 'delivered' group by 1
    union all
    select strftime(order_purchase_ts, '%Y-%m'), null, count(*),
           count(*) filter (where delivered_at > estimated_delivery_at) from s_orders group by 1""")
def _(t):
    """Two gold reports of the same run: totals by category, and late deliveries by month."""
    _, built = change_layers(t)
    totals = built["category_totals"].select("category", F.round("total_revenue", 2).alias("total_revenue"),
                                             "order_count", "item_count")
    months = built["monthly_delivery"].select(
        F.col("order_month").alias("category"), F.lit(None).cast("double").alias("total_revenue"), "order_count",
        F.col("late_delivery_count").alias("item_count"))
    return totals.unionByName(months)


# --- N16-N22 as streams -------------------------------------------------------------------

def append_result(t, table: str, landed: DataFrame) -> DataFrame:
    """The append track's silver table, streamed from bronze in two runs; rejects have a table of their own."""
    feed = Feed(t.spark)
    for k in (0, 1):
        feed.land(landed.filter(F.pmod(F.xxhash64(*landed.columns), F.lit(2)) == k))
        feed.ingest()
        rows = silver.APPEND_TRACK[table](flows.stream_of(t.spark, feed.bronze))
        flows.append_flow(rows, silver.append_rules()[table], f"{feed.root}/silver", f"{feed.root}/checkpoint_silver",
                          rejects_dir=f"{feed.root}/rejects")
    return t.spark.read.parquet(f"{feed.root}/silver").drop("batch_id")


def as_stream(name: str, batch_query: str):
    """Registers a streamed form under the SQL of the batch form."""
    return query(name, ORACLE[batch_query])


@as_stream("n16_stream_orders", "n16_append_orders")
def _(t):
    return naive(append_result(t, "orders", t.landed_orders))


@as_stream("n16_stream_order_items", "n16_append_order_items")
def _(t):
    return append_result(t, "order_items", t.landed_order_items).withColumn(
        "price_with_freight", F.round("price_with_freight", 4))


@as_stream("n16_stream_products", "n16_append_products")
def _(t):
    return append_result(t, "products", t.landed_products).drop(silver.SOURCE, silver.INGESTED)


@as_stream("n16_stream_sellers", "n16_append_sellers")
def _(t):
    return append_result(t, "sellers", t.landed_sellers)


@as_stream("n16_stream_order_reviews", "n16_append_order_reviews")
def _(t):
    return naive(append_result(t, "order_reviews", t.landed_order_reviews))


@query("k2_rejected_rows", """
    select order_id::varchar as order_id, ['has_customer'] as rejected_by from s_orders where customer_id % 7 = 0""")
def _(t):
    """Rows that a drop rule turned away, kept with the rule's name."""
    feed = Feed(t.spark)
    feed.land(t.landed_orders.withColumn("customer_id", F.when(F.col("customer_id") % 7 != 0, F.col("customer_id"))))
    feed.ingest()
    flows.append_flow(flows.stream_of(t.spark, feed.bronze), [Rule("has_customer", F.col("customer_id").isNotNull(), DROP)],
                      f"{feed.root}/silver", f"{feed.root}/checkpoint_silver", rejects_dir=f"{feed.root}/rejects")
    return t.spark.read.parquet(f"{feed.root}/rejects").select("order_id", F.col("_rejected_by").alias("rejected_by"))


@query("k3_append_fails_whole_batch", """
    select order_id::varchar as order_id, order_status from s_orders where order_id % 2 = 0
    union all select 'failed', count(*)::varchar from s_orders where order_id % 2 = 1 and order_id % 5 = 0 having count(*) > 0""")
def _(t):
    """A batch that violates a fail rule writes nothing; what came before stays."""
    feed = Feed(t.spark)
    rows = t.landed_orders.select("order_id", "order_status")
    broken = rows.filter(F.col("order_id") % 2 == 1).withColumn(
        "order_id", F.when(F.col("order_id") % 5 != 0, F.col("order_id")))
    must = [Rule("has_id", F.col("order_id").isNotNull(), FAIL)]
    failed = []
    for part in (rows.filter(F.col("order_id") % 2 == 0), broken):
        feed.land(part)
        feed.ingest()
        stream = flows.stream_of(t.spark, feed.bronze).select("order_id", "order_status")
        try:
            flows.append_flow(stream, must, f"{feed.root}/silver", f"{feed.root}/checkpoint_silver")
        except StreamingQueryException as error:
            failed += re.findall(r"'has_id': (\d+)", str(error))[:1]
    stored = t.spark.read.parquet(f"{feed.root}/silver").select("order_id", "order_status")
    note = t.spark.createDataFrame([("failed", n) for n in failed], "order_id string, order_status string")
    return stored.unionByName(note)


def change_result(t, table: str, landed: DataFrame, stage) -> DataFrame:
    """A silver table through its change flow, in two batches; the second delivers half of the first again."""
    feed = Feed(t.spark)
    spec = silver.change_tables()[table]
    half = F.pmod(F.xxhash64(*landed.columns), F.lit(4))
    for part in (half < 2, half > 0):
        feed.land(landed.filter(part))
        feed.ingest()
        flows.change_flow(t.spark, feed.bronze, stage, spec, f"{feed.root}/silver", f"{feed.root}/checkpoint_silver", buckets=4)
    return flows.read_type1(t.spark, f"{feed.root}/silver", spec.keys).drop(silver.SOURCE, silver.INGESTED)


def arrived(stage, instant):
    """The stage with the time of arrival taken from the data, so that both engines know it."""
    return lambda landed: stage(landed.withColumn(silver.INGESTED, instant))


@as_stream("n17_flow_customers", "n17_slv_customers")
def _(t):
    return change_result(t, "customers", t.landed_customers, silver.customers_staged)


@as_stream("n18_flow_order_items", "n18_slv_order_items")
def _(t):
    instant = F.timestamp_add("SECOND", F.col("product_id").cast("int"), F.to_timestamp("shipping_limit_date"))
    rows = change_result(t, "order_items", t.landed_order_items, arrived(silver.order_items_staged, instant))
    return naive(rows.withColumn("total_item_value", F.round("total_item_value", 4)))


@as_stream("n19_flow_orders", "n19_slv_orders")
def _(t):
    return naive(change_result(t, "orders", t.landed_orders, silver.orders_staged))


@as_stream("n20_flow_products", "n20_slv_products")
def _(t):
    return change_result(t, "products", t.landed_products, lambda df: silver.products_staged(df, t.translation))


@as_stream("n21_flow_reviews", "n21_slv_reviews")
def _(t):
    instant = F.to_timestamp("review_answer_timestamp")
    return naive(change_result(t, "reviews", t.landed_order_reviews, arrived(silver.reviews_staged, instant)))


@as_stream("n22_flow_sellers", "n22_slv_sellers")
def _(t):
    return change_result(t, "sellers", t.landed_sellers, silver.sellers_staged)


# --- I10 a stream behind a changing table ------------------------------------------------------

@query("i10_inserts_of_a_changing_table", """
    select order_id, customer_id, case when order_status = 'canceled' then 'canceled' else 'created' end as order_status
    from s_orders""")
def _(t):
    """Of an insert, a merge, an update and a restore only new rows arrive, each once, over two runs."""
    path, out = versioned(t), scratch(t.spark, "inserts")
    checkpoint = f"{out}-checkpoint"
    flows.insert_flow(t.spark, path, ["order_id"], out, checkpoint)
    V.publish(V.as_of_version(t.spark, path).withColumn("order_status", F.lit("lost")), path, "update")
    V.restore(t.spark, path, 0)
    flows.insert_flow(t.spark, path, ["order_id"], out, checkpoint)
    return t.spark.read.parquet(out).select("order_id", "customer_id", "order_status")
