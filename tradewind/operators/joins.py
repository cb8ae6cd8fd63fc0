"""Joins to lookup tables, and rows without a partner."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def lookup_join(left: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "left"
                ) -> DataFrame:
    """Join to a lookup table. AQE broadcasts its side if the real size is below Spark's threshold."""
    return left.join(small, on, how)


def fixed_lookup_join(left: DataFrame, seed: DataFrame, on: str | Sequence[str], how: str = "left"
                      ) -> DataFrame:
    """The same with the broadcast hint, for seeds whose rows are part of the program."""
    return left.join(F.broadcast(seed), on, how)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but missing from the parent."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.filter(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")
