"""Best-of-group, latest-of-key and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_group(df: DataFrame, group: Sequence[str], by: str) -> DataFrame:
    """Rows holding the largest ``by`` of their group, ties included.

    The maximum is an aggregate that combines before the shuffle, so a group
    with a large share of the rows never has to be sorted in one task.
    """
    best = df.groupBy(*group).agg(F.max(by).alias("__best"))
    same_group = [F.col(f"d.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group]
    return (df.alias("d")
            .join(best.alias("b"), [*same_group, F.col(f"d.{by}") == F.col("b.__best")],
                  "left_semi"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order.

    Keeping row number 1 lets Spark drop all other rows of a key before the
    shuffle (WindowGroupLimit), so repeated keys cost nothing downstream.
    """
    numbered = df.withColumn("__n", F.row_number().over(
        Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col("__n") == 1).drop("__n")


def top_n(df: DataFrame, n: int, order: Sequence[Column], rank: str | None = None,
          at_least: Column | None = None) -> DataFrame:
    """The first n rows in order, after an optional threshold, numbered from 1 on request."""
    kept = df if at_least is None else df.filter(at_least)
    top = kept.orderBy(*order).limit(n)
    if rank is None:
        return top
    # n rows at most reach this window
    return top.withColumn(rank, F.row_number().over(Window.orderBy(*order)))
