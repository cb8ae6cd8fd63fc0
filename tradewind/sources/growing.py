"""Stored tables that a run changes in part: a fact by month, a snapshot with open and closed rows.

Both are versioned tables (see ``versions``) split into parts. A run writes the
parts it touches and publishes them at once; the files of all other parts stay,
and a run that dies leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import columns as X
from tradewind.operators import changes
from tradewind.session import scratch
from tradewind.sources import versions as V


def _stored(rows: DataFrame, label: str) -> DataFrame:
    path = scratch(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _numbers(rows: DataFrame, part: Column) -> set[int]:
    """The parts that rows fall in: at most ``V.MOST_BUCKETS`` numbers, as one row."""
    return set(V.buckets_in(rows.agg(V.bucket_bits(part).alias("bits")).first().bits))


# --- a fact that grows by its newest rows --------------------------------------

def month_part(cursor: str) -> Column:
    """Months since year 0; rows without an instant form part 0."""
    return F.coalesce(12 * F.year(cursor) + F.month(cursor) - 1, F.lit(0)).cast("int")


def grow_by_month(spark: SparkSession, source: DataFrame, path: str, key: Sequence[str], cursor: str,
                  full_refresh: bool = False, lookback: str | None = None) -> DataFrame:
    """Merges the source rows newer than the stored table into it, month by month of ``cursor``.

    The newest instant is read from the newest month alone. Rewritten are the
    months of the new rows and those in which the table holds their keys; the
    table is looked through for these by its key and cursor columns only.
    Otherwise as ``changes.incremental``.
    """
    part = month_part(cursor)
    known = None if full_refresh else V.newest(spark, path)
    months = sorted(b for b in known.placed if b > 0) if known is not None else []
    if not months:  # nothing stored, or no row with an instant: everything is taken
        target = V.as_of_version(spark, path, known=known) if known is not None else None
        V.publish(changes.incremental(target, source, key, cursor), path, "full", part=part)
        return V.as_of_version(spark, path)
    last = V.as_of_version(spark, path, buckets=months[-1:], known=known)
    kind = last.schema[cursor].dataType
    since = F.lit(last.agg(F.max(cursor).cast("string")).first()[0]).cast(kind)
    if lookback is not None:
        since = since - F.expr(f"interval {lookback}")
    new = _stored(source.filter(F.col(cursor) > since), "new-rows")
    held = changes.same_keys(V.as_of_version(spark, path, known=known).select(*key, cursor).dropna(subset=list(key)),
                             new.select(*key), key, "left_semi")
    touched = sorted(_numbers(new, part) | _numbers(held, part))
    if touched:
        stored = V.as_of_version(spark, path, buckets=touched, known=known)
        V.publish(changes.merge(stored, new, key), path, "merge", touched=touched, part=part)
    return V.as_of_version(spark, path)


# --- a snapshot of checked columns -----------------------------------------------

OPEN_PARTS = 1 << 14  # open rows in buckets below, the closed rows of version v in part OPEN_PARTS + v


def open_buckets(rows: int, rows_per_bucket: int) -> int:
    return min(OPEN_PARTS, max(1, -(-rows // rows_per_bucket)))


FILES_PER_TASK, ROWS_PER_TASK = 64, 250_000


def _spread(rows: DataFrame, part: Column, keys: Sequence[str], number: int, rows_per_bucket: int) -> tuple[DataFrame, bool]:
    """Rows of small buckets, dealt to tasks by bucket so that none writes very many files; and whether they were.

    A rebalance goes by bytes and would leave all small buckets to one task.
    Closed rows share one part, which all tasks write to.
    """
    buckets = min(FILES_PER_TASK, ROWS_PER_TASK // max(1, rows_per_bucket))
    if buckets < 2 or number <= buckets:
        return rows, False
    closed = F.when(F.col(changes.VALID_TO).isNotNull(), F.xxhash64(*keys))
    return rows.repartition(-(-number // buckets), part, closed), True


def grow_snapshot(spark: SparkSession, source: DataFrame, path: str, key: Sequence[str],
                  check_cols: Sequence[str], run_ts: Column, rows_per_bucket: int = 10_000_000) -> DataFrame:
    """Adds a version for every row whose checked columns changed, closing the old one.

    A run reads the open rows, rewrites the buckets in which some open or close,
    and writes the rows it closes to a part of their own that no later run reads
    or rewrites. Keys that vanish from the source stay open.
    """
    keys = list(key)
    changes.check_unique(source, keys)
    known = V.newest(spark, path)
    opened = changes.opened_rows(source, run_ts)
    if known is None:
        number = open_buckets(source.count(), rows_per_bucket)
        rows, laid_out = _spread(opened, X.key_bucket(keys, number), keys, number, rows_per_bucket)
        V.publish(rows, path, "snapshot", keys, number, laid_out=laid_out)
        return V.as_of_version(spark, path)
    number = known.bucket_count
    here = X.key_bucket(keys, number)
    parts = [b for b in known.placed if b < OPEN_PARTS]
    current = V.as_of_version(spark, path, buckets=parts, known=known)
    fresh = _stored(changes.snapshot_news(current, opened, keys, check_cols), "snapshot-news")
    buckets = sorted(_numbers(fresh, here))
    if buckets:
        shelf = OPEN_PARTS + known.version + 1
        if shelf >= V.MOST_BUCKETS:
            raise ValueError("more runs than a snapshot has parts for: publish it whole into a new path")
        touched = V.as_of_version(spark, path, buckets=buckets, known=known)
        ended = changes.same_keys(touched, fresh, keys, "left_semi").withColumn(changes.VALID_TO, run_ts)
        staying = changes.same_keys(touched, fresh, keys, "left_anti").unionByName(fresh.select(*touched.columns))
        part = F.when(F.col(changes.VALID_TO).isNull(), here).otherwise(F.lit(shelf))
        rows, laid_out = _spread(staying.unionByName(ended.select(*touched.columns)), part, keys, number, rows_per_bucket)
        V.publish(rows, path, "snapshot", keys, number, [*buckets, shelf], part=part, laid_out=laid_out)
    return V.as_of_version(spark, path)
