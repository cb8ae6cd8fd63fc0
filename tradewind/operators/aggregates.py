"""Aggregation patterns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.functions import columns as X


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_name: str = "n") -> DataFrame:
    """Fully set keys that occur more than once, with their count."""
    complete = df.dropna(subset=list(keys))
    return (complete.groupBy(*keys).agg(X.rows().alias(count_name))
            .filter(F.col(count_name) > 1))


def share_of_total(counts: DataFrame, value: str, share: str, digits: int = 1) -> DataFrame:
    """Adds each row's percentage of the whole column.

    The total is a scalar subquery over the same aggregate, whose shuffle Spark
    reuses, so the rows are never gathered into one task.
    """
    total = counts.agg(F.sum(value)).scalar()
    return counts.withColumn(share, F.round(
        F.col(value).cast("double") * 100 / total.cast("double"), digits))


def salted_agg(df: DataFrame, keys: Sequence[str], sums: dict[str, Column],
               buckets: int) -> DataFrame:
    """Two-pass count and sums for keys that hold a large share of the rows.

    The salt is the number of the map task, which stays the same when a lost
    task runs again; a random salt would not, and could count rows twice.
    Plain ``groupBy`` already combines counts and sums before its shuffle, so
    this pays off only where a hot key still reaches one reducer from very
    many tasks.
    """
    salted = df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(buckets)))
    first = salted.groupBy(*keys, "__salt").agg(
        X.rows().alias("rows"), *[F.sum(c).alias(n) for n, c in sums.items()])
    return first.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), *[F.sum(n).alias(n) for n in sums])
