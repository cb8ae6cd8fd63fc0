"""Reading and writing whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def publish_views(spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Makes tables readable by name, from SQL and from ``spark.table``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)


def inline_rows(spark: SparkSession, rows: Sequence, schema: str, view: str | None = None
                ) -> DataFrame:
    """A few literal rows, for change sets written by hand."""
    df = spark.createDataFrame(rows, schema)
    if view is not None:
        df.createOrReplaceTempView(view)
    return df


def full_refresh(df: DataFrame, path: str) -> DataFrame:
    """Replaces the table at the path; returns it as stored."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def create_table_as(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Creates or replaces a catalog table with the rows."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def except_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[F.col(c) for c in df.columns if c not in names])
