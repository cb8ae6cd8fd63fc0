"""The sentiment label as Python functions, kept to compare with the built-in form."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def sentiment_by_batch(score: str) -> Column:
    """Arrow batches; a missing score is labelled like the built-in form labels it."""
    @F.pandas_udf("string")
    def label(scores: pd.Series) -> pd.Series:
        return pd.Series("negative", index=scores.index).mask(scores == 3, "neutral").mask(
            scores >= 4, "positive")
    return label(F.col(score))


def sentiment_by_row(score: str) -> Column:
    """One Python call per row: the slow form, which fails on a missing score."""
    @F.udf("string")
    def label(value):
        if value >= 4:
            return "positive"
        if value == 3:
            return "neutral"
        return "negative"
    return label(F.col(score))
