"""Landing zone: delivered CSV files as parquet, every column a string."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.sources import multiline as records

CSV_TEXT = {"header": True, "escape": '"'}


class MissingFiles(Exception):
    pass


def read_text_csv(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A CSV file, or a folder of such files, with every column as the text it holds.

    Free text that spans lines needs ``multiline``; such files too are read by many tasks.
    """
    if not multiline:
        return spark.read.options(**CSV_TEXT).csv(path)
    fields = spark.read.options(**CSV_TEXT, multiLine=True).csv(path).columns
    return records.parsed(records.records(spark, [path]), fields, "__malformed").drop("__path", "__malformed")


def prepare_landing(spark: SparkSession, csv_by_table: Mapping[str, str], out_dir: str,
                    multiline: Sequence[str] = ("order_reviews",)) -> DataFrame:
    """Writes ``out_dir/<table>``; returns (table, rows). All files must exist beforehand."""
    frames, missing = {}, []
    for table, path in csv_by_table.items():
        try:
            frames[table] = read_text_csv(spark, path, table in multiline)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(path)
    if missing:
        raise MissingFiles(", ".join(missing))
    written = []
    for table, df in frames.items():
        path = os.path.join(out_dir, table)
        df.write.mode("overwrite").parquet(path)
        written.append(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
                       .select(F.lit(table).alias("table"), "rows"))
    return reduce(DataFrame.unionByName, written)


def typed_scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns of the schema only, cast to its types."""
    stored = spark.read.parquet(path)
    return stored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small lookup table kept as CSV beside the code."""
    return spark.read.schema(schema).option("header", True).csv(path)


def rescue_cast(texts: DataFrame, schema: T.StructType, rescued: str = "_rescued_data",
                malformed: str | None = None) -> DataFrame:
    """Casts text columns to the schema; what does not fit stays as JSON in ``rescued``.

    ``malformed`` names a column holding the whole line of rows that could not
    be split into the expected number of fields.
    """
    present = [f for f in schema.fields if f.name in texts.columns]
    lost = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
                   F.col(f.name)).alias(f.name)
            for f in present if not isinstance(f.dataType, T.StringType)]
    if malformed is not None:
        lost.append(F.col(malformed))
    note = F.lit(None).cast("string")
    if lost:  # to_json leaves out NULL fields
        note = F.when(F.coalesce(*[c.cast("string") for c in lost]).isNotNull(),
                      F.to_json(F.struct(*lost)))
    others = [c for c in texts.columns if c not in schema.names and c != malformed]
    return texts.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) if f in present
          else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
        *others, note.alias(rescued))


def rescue_types(rows: DataFrame, schema: T.StructType, rescued: str = "_rescued_data") -> DataFrame:
    """Brings columns of other types to the schema; what does not fit stays as JSON in ``rescued``.

    A text fits where it can be cast, a number where casting loses nothing.
    """
    have = {f.name: f.dataType for f in rows.schema.fields}
    lost, fitted = [], []
    for f in schema.fields:
        if have.get(f.name, f.dataType) == f.dataType:
            fitted.append(F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value, cast = F.col(f.name), F.col(f.name).try_cast(f.dataType)
        fits = cast.isNotNull()
        if isinstance(have[f.name], T.NumericType) and isinstance(f.dataType, T.NumericType):
            fits &= F.coalesce(cast.try_cast(have[f.name]) == value, F.lit(False))
        fitted.append(F.when(fits, cast).alias(f.name))
        lost.append(F.when(value.isNotNull() & ~fits, value.cast("string")).alias(f.name))
    note = F.lit(None).cast("string")
    if lost:
        note = F.when(F.coalesce(*lost).isNotNull(), F.to_json(F.struct(*lost)))
    others = [c for c in rows.columns if c not in schema.names]
    return rows.select(*fitted, *others, note.alias(rescued))
