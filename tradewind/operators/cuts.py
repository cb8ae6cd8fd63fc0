"""Cutting columns into ranges of about equal row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLED_ROWS = 1_000_000  # rows that decide where the cuts lie


def quantile_pieces(df: DataFrame, columns: Sequence[str], pieces: int) -> dict[str, Column]:
    """For each column the number of the piece a row falls in, 0 to at most ``pieces - 1``.

    The cuts come from one pass over a sample of about ``SAMPLED_ROWS`` rows, so
    that what their sketches bring to one task is bounded; every row is placed by
    them. They are read once and stay literals: every use of the expressions,
    also in a task that runs again, sees the same pieces.
    """
    if not columns:
        return {}
    share = min(1.0, SAMPLED_ROWS / max(1, df.count()))
    shares = [i / pieces for i in range(1, pieces)]
    rows = df.select(*columns) if share == 1.0 else df.select(*columns).sample(share, seed=0)
    found = rows.agg(*[F.percentile_approx(c, shares, 100 * pieces).alias(c) for c in columns]).select(
        *[F.array_distinct(c).cast("array<string>").alias(c) for c in columns]).first()
    return {c: _place(c, df.schema[c].dataType.simpleString(), found[c] or []) for c in columns}


def _place(column: str, kind: str, cuts: Sequence[str]) -> Column:
    def place(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return (f"case when `{column}` <= cast('{cuts[middle]}' as {kind}) "
                f"then {place(low, middle)} else {place(middle + 1, high)} end")

    return F.expr(place(0, len(cuts)))
