"""Tables kept as published versions on plain parquet.

Every change writes new files and then one row into the table's list of
versions; readers see only what the list names. One writer at a time; old files
are kept. A table may be split into numbered parts, by default the buckets of
its key: a change then rewrites only the parts it touches. Each row of the list
is complete in itself: it says which version holds the files of every part, the
schema, and the last batch of each flow, so that a reader or writer looks at one
row only.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions import columns as X
from tradewind.sources.layout import COMPACT_BYTES

BUCKET = "__bucket"
UNPARTED = -1  # the one part of a table that is not split
MOST_BUCKETS = 1 << 15  # parts of a table: as many as one bitmap has bits
LIST_SCHEMA = ("version int, published_at timestamp, operation string, rows bigint, total bigint, "
               "flow string, batch_id bigint, keys array<string>, bucket_count int, restored int, "
               "placed map<int,int>, applied map<string,bigint>, body string")


def list_path(path: str) -> str:
    """Where the list is kept: one small file for each version."""
    return os.path.join(path, "versions")


def _files(path: str, version: int) -> str:
    return os.path.join(path, "data", f"version={version}")


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The list of versions: when, by which operation, how many rows were written and are there in all."""
    try:
        return spark.read.schema(LIST_SCHEMA).parquet(list_path(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LIST_SCHEMA)


def newest(spark: SparkSession, path: str, version: int | None = None) -> Row | None:
    """The newest row of the list, or the newest up to a version; None before the first."""
    listed = versions(spark, path)
    if version is not None:
        listed = listed.filter(F.col("version") <= version)
    return listed.orderBy(F.desc("version")).first()


def latest_version(spark: SparkSession, path: str) -> int | None:
    last = newest(spark, path)
    return None if last is None else last.version


def applied_up_to(known: Row | None, flow: str) -> int:
    """The last batch of a flow that a version holds; a batch may be delivered again."""
    return -1 if known is None else known.applied.get(flow, -1)


def bucketing(spark: SparkSession, path: str) -> tuple[list[str], int] | None:
    """Keys and number of buckets of the newest version; None before the first."""
    last = newest(spark, path)
    return None if last is None else (list(last["keys"] or ()), last.bucket_count or 0)


class BucketMismatch(Exception):
    """Touched buckets of another bucket count cannot join the stored ones."""


def bucket_bits(bucket: Column) -> Column:
    """An aggregate: the set of bucket numbers below ``MOST_BUCKETS``, one bit each; NULL is left out."""
    return F.call_function("bitmap_construct_agg", bucket.cast("long"))


def buckets_in(bits: bytes | None) -> list[int]:
    return [8 * i + k for i, byte in enumerate(bits or b"") if byte for k in range(8) if byte >> k & 1]


def publish(df: DataFrame, path: str, operation: str, keys: Sequence[str] = (),
            buckets: int = 0, touched: Sequence[int] | None = None,
            flow: str | None = None, batch_id: int | None = None,
            restored: int | None = None, cluster_by: Sequence[str] = (), part: Column | None = None, laid_out: bool = False) -> int:
    """Writes the rows as the next version, or as that version's touched parts.

    A row's part is its bucket of the keys, or the number that ``part`` gives.
    Keys and number of buckets are stored with each version. Only a whole
    version may change them (see ``rebucket``). Within a part's files rows are
    sorted by ``cluster_by``; ``laid_out`` rows are written by the tasks that
    hold them. Rows are counted in the stored files, of which only
    the footers are read: metrics observed on the way are lost where adaptive
    execution drops a branch that turns out to be empty.
    """
    spark = df.sparkSession
    last = newest(spark, path)
    if touched is not None and last is not None and (list(last["keys"] or ()), last.bucket_count) != (list(keys), buckets):
        raise BucketMismatch(f"the table has {(last['keys'], last.bucket_count)}, not {(list(keys), buckets)}")
    version = 0 if last is None else last.version + 1
    whole = touched is None or last is None
    body = T.StructType([f for f in df.schema.fields if f.name != BUCKET])
    placed = {UNPARTED: version}
    if part is None and buckets:
        part = X.key_bucket(keys, buckets)
    if part is not None:
        if buckets > MOST_BUCKETS:
            raise ValueError(f"at most {MOST_BUCKETS} buckets")
        parted = df.withColumn(BUCKET, part.cast("int"))
        if not laid_out:
            parted = parted.hint("rebalance", BUCKET)
        order = [c for c in cluster_by if c in df.columns and not isinstance(df.schema[c].dataType, T.StructType)]
        if order:
            parted = parted.sortWithinPartitions(BUCKET, *order)
        parted.write.mode("overwrite").partitionBy(BUCKET).parquet(_files(path, version))
        stored = (spark.read.schema(T.StructType([*body.fields, T.StructField(BUCKET, T.IntegerType())]))
                  .parquet(_files(path, version)))
        present = {r[BUCKET]: r.n for r in stored.groupBy(BUCKET).agg(X.rows().alias("n")).collect()}  # a row a part
        rows = sum(present.values())
        placed = {} if whole else {b: v for b, v in last.placed.items() if b not in set(touched)}
        placed.update((b, version) for b in present)
    else:
        df.write.mode("overwrite").parquet(_files(path, version))
        rows = spark.read.schema(body).parquet(_files(path, version)).count()
    total = rows
    if not whole:
        total = None if last.total is None else last.total - as_of_version(spark, path, buckets=touched, known=last).count() + rows
    applied = dict(last.applied or {}) if last is not None else {}
    if flow is not None:
        applied[flow] = batch_id
    if last is not None and not whole:
        body = T.StructType([*body.fields, *[f for f in _body(last).fields if f.name not in body.names]])
    _list_version(spark, path, (version, None, operation, rows, total, flow, batch_id, list(keys), buckets, restored,
                                placed, applied, body.json()))
    return version


def _list_version(spark: SparkSession, path: str, row: tuple) -> None:
    (spark.createDataFrame([row], LIST_SCHEMA).withColumn("published_at", F.current_timestamp())
     .coalesce(1).write.mode("append").parquet(list_path(path)))


def _body(known: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(known.body))


def version_at(spark: SparkSession, path: str, moment: str) -> int | None:
    """The newest version published at or before an instant, given as text or as a literal's value."""
    return versions(spark, path).filter(
        F.col("published_at") <= F.lit(moment).cast("timestamp")).agg(F.max("version")).first()[0]


def as_of_version(spark: SparkSession, path: str, version: int | None = None,
                  buckets: Sequence[int] | None = None, moment: str | None = None,
                  known: Row | None = None, with_part: bool = False) -> DataFrame | None:
    """The table at a version or an instant (default: latest), or only some of its parts.

    None when there is nothing to read yet. Of the list, only one row comes to
    the driver, or none where the caller has it (``known``).
    """
    if moment is not None:
        version = version_at(spark, path, moment)
        if version is None:
            return None
    if known is None:
        known = newest(spark, path, version)
    if known is None:
        return None
    schema = _body(known)
    if UNPARTED in known.placed:
        return spark.read.schema(schema).parquet(_files(path, known.placed[UNPARTED]))
    wanted = known.placed.keys() if buckets is None else set(buckets)
    folders = [os.path.join(_files(path, v), f"{BUCKET}={b}") for b, v in sorted(known.placed.items()) if b in wanted]
    if not folders:
        return spark.createDataFrame([], schema)
    base = os.path.join(path, "data")
    rows = spark.read.schema(schema).option("basePath", base).parquet(*folders)
    return rows.select(*schema.names, *([BUCKET] if with_part else []))


def live_batches(spark: SparkSession, path: str) -> DataFrame:
    """(flow, batch_id) of the batches whose changes the newest version shows.

    A restore takes back the batches after the version it restored.
    """
    listed = versions(spark, path)
    spans, high = [], latest_version(spark, path)
    while high is not None:
        undo = listed.filter((F.col("version") <= high) & F.col("restored").isNotNull()).orderBy(
            F.desc("version")).select("version", "restored").first()
        spans.append((undo.version + 1 if undo else 0, high))
        high = undo.restored if undo else None
    inside = reduce(lambda a, b: a | b, [F.col("version").between(a, b) for a, b in spans], F.lit(False))
    return listed.filter(inside & F.col("batch_id").isNotNull()).select("flow", "batch_id").distinct()


def version_diff(spark: SparkSession, path: str, old: int, new: int,
                 key: Sequence[str]) -> DataFrame:
    """Keys that were added, removed or changed between two versions."""
    before, after = as_of_version(spark, path, old), as_of_version(spark, path, new)
    compared = [c for c in after.columns if c in before.columns and c not in key]
    row = F.struct(*[F.col(c) for c in compared])
    both = (before.select(*key, row.alias("old")).join(
        after.select(*key, row.alias("new")), list(key), "full"))
    same: Column = reduce(lambda a, b: a & b, [
        F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in compared], F.lit(True))
    change = (F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed")
              .when(~same, "changed"))
    return both.select(*key, change.alias("change")).filter(F.col("change").isNotNull())


def restore(spark: SparkSession, path: str, version: int) -> int:
    """Publishes an old version again as the newest one.

    Only the row of the list is written: the files of the old version are there still.
    """
    old = versions(spark, path).filter(F.col("version") == version).first()
    if old is None:
        raise ValueError(f"{path} has no version {version}")
    last = newest(spark, path)
    _list_version(spark, path, (
        last.version + 1, None, f"restore {version}", old["rows"] if old.total is None else old.total, old.total, None, None,
        old["keys"], old.bucket_count, version, old.placed, last.applied, old.body))
    return last.version + 1


def rebucket(spark: SparkSession, path: str, buckets: int) -> int:
    """Publishes the newest version in another number of buckets."""
    keys, _ = bucketing(spark, path)
    return publish(as_of_version(spark, path), path, f"rebucket {buckets}", keys, buckets)


def pack(spark: SparkSession, path: str, target_bytes: int = COMPACT_BYTES, small: float = 0.5) -> list[int]:
    """Rewrites the parts of a table that have several small files; returns their numbers.

    A file is small below ``small`` of the target. A part is left alone when its
    bytes need as many files as it has, so that packing again does nothing. The
    files of all other parts keep their names. What is to be done follows from
    the listing of the files alone, and readers see the packed parts from the
    moment they are published.
    """
    known = newest(spark, path)
    if known is None or UNPARTED in known.placed:
        return []
    folders = [os.path.join(_files(path, v), f"{BUCKET}={b}") for b, v in sorted(known.placed.items())]
    if not folders:
        return []
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
             .load(folders).select(F.regexp_extract("path", f"/{BUCKET}=(\\d+)/", 1).cast("int").alias("part"), "length"))
    crowded = (files.groupBy("part").agg(
        F.count_if(F.col("length") < small * target_bytes).alias("small"), X.rows().alias("now"),
        F.ceil(F.sum("length") / target_bytes).cast("int").alias("files")).filter("small > 1 and now > files"))
    found = sorted((r.part, r.files) for r in crowded.select("part", "files").collect())  # a row a part
    if found:
        before = [0, *accumulate(n for _, n in found)]
        slots = F.broadcast(spark.createDataFrame(
            [(part, first, n) for (part, n), first in zip(found, before)], f"{BUCKET} int, __first int, __files int"))
        rows = as_of_version(spark, path, buckets=[part for part, _ in found], known=known, with_part=True)
        slot = F.col("__first") + F.pmod(F.xxhash64(*rows.columns), F.col("__files")).cast("int")
        rows = rows.join(slots, BUCKET).repartitionById(before[-1], slot).drop("__first", "__files")
        publish(rows, path, "pack", known["keys"], known.bucket_count, [part for part, _ in found], part=F.col(BUCKET),
                laid_out=True)
    return [part for part, _ in found]
