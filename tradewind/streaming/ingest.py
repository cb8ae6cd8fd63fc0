"""Incremental file ingestion: every file once, with provenance.

Spark's checkpoint decides which files are new. A schema is inferred on the
first run and kept beside the checkpoint. A file with a new column makes one
run fail after the wider schema has been stored; the next run takes it in.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.plans.silver import INGESTED, SOURCE
from tradewind.session import STORED_CODEC
from tradewind.sources import multiline
from tradewind.sources.landing import CSV_TEXT, rescue_cast, rescue_types
from tradewind.streaming.progress import run_to_end

RESCUED = "_rescued_data"
MALFORMED = "_malformed"
OTHER_HEADER = "CSV header does not conform to the schema"  # as Spark reports it


class SchemaWidened(Exception):
    """New columns were found and stored; run the ingestion again."""


def with_provenance(df: DataFrame, ingested: str = INGESTED) -> DataFrame:
    return (df.withColumn(SOURCE, F.col("_metadata.file_path"))
            .withColumn(ingested, F.current_timestamp()))


# --- stored schema -------------------------------------------------------------

def _schema_dir(checkpoint: str) -> str:
    return checkpoint.rstrip("/") + "_schema"


def load_schema(spark: SparkSession, checkpoint: str) -> T.StructType | None:
    try:
        kept = spark.read.schema("revision int, body string").json(_schema_dir(checkpoint))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return T.StructType.fromJson(json.loads(
        kept.orderBy(F.desc("revision")).first()["body"]))


def save_schema(spark: SparkSession, checkpoint: str, schema: T.StructType) -> None:
    spark.createDataFrame([(len(schema.fields), schema.json())], "revision int, body string") \
        .coalesce(1).write.mode("append").json(_schema_dir(checkpoint))


def widen(stored: T.StructType, seen: T.StructType) -> T.StructType | None:
    """The stored schema with unseen columns appended; None when there are none."""
    new = [f for f in seen.fields if f.name not in stored.names]
    return T.StructType([*stored.fields, *new]) if new else None


# --- ingestion -------------------------------------------------------------------

def ingest_files(spark: SparkSession, src_dir: str, fmt: str, out_dir: str, checkpoint: str,
                 glob: str | None = None, schema: T.StructType | None = None,
                 rescue: bool = True, multiline: bool = False, sampling: float = 1.0,
                 files_per_batch: int = 1000, ingested: str = INGESTED, mixed_types: bool = False) -> int:
    """Appends the files not seen before to ``out_dir``; returns how many rows that were.

    ``mixed_types`` takes parquet files in which a column has another type than
    in the stored schema: values that do not fit it stay in ``_rescued_data``.
    Without it such a file stops the run.
    """
    if fmt == "parquet" and mixed_types:
        reader = _ParquetReader(spark, src_dir, checkpoint, schema)
        return _ingest_by_batch(spark, reader, src_dir, out_dir, checkpoint, glob, files_per_batch, ingested)
    if fmt == "parquet":
        return _ingest_parquet(spark, src_dir, out_dir, checkpoint, glob, schema,
                               files_per_batch, ingested)
    if fmt == "csv":
        reader = _CsvReader(spark, src_dir, checkpoint, schema, rescue, multiline, sampling)
        return _ingest_by_batch(spark, reader, src_dir, out_dir, checkpoint, glob, files_per_batch,
                                ingested)
    raise ValueError(f"unknown format {fmt}")


def _ingest_parquet(spark, src_dir, out_dir, checkpoint, glob, schema, files_per_batch,
                    ingested) -> int:
    options = {"pathGlobFilter": glob} if glob else {}
    stored = schema or load_schema(spark, checkpoint)
    if schema is None:
        seen = spark.read.options(**options, mergeSchema=True).parquet(src_dir).schema
        if stored is None:
            stored = seen
            save_schema(spark, checkpoint, stored)
        elif (wider := widen(stored, seen)) is not None:
            save_schema(spark, checkpoint, wider)
            raise SchemaWidened(f"new columns {wider.names[len(stored.names):]} in {src_dir}")
    files = (spark.readStream.schema(stored).options(**options)
             .option("maxFilesPerTrigger", files_per_batch).parquet(src_dir))
    writer = (with_provenance(files, ingested).writeStream.format("parquet")
              .option("compression", STORED_CODEC).option("path", out_dir).option("checkpointLocation", checkpoint)
              .outputMode("append").trigger(availableNow=True))
    return run_to_end(spark, writer)[0]


def _ingest_by_batch(spark, reader, src_dir, out_dir, checkpoint, glob, files_per_batch,
                     ingested) -> int:
    """The stream carries file names only; each batch reads its files by their own columns.

    A batch owns one folder of the output, so a batch delivered twice replaces
    its own rows.
    """
    options = {"pathGlobFilter": glob} if glob else {}
    listing = (spark.readStream.format("binaryFile").options(**options)
               .schema("path string, modificationTime timestamp, length bigint, content binary")
               .option("maxFilesPerTrigger", files_per_batch).load(src_dir).select("path"))
    total = 0

    def take(batch: DataFrame, batch_id: int) -> None:
        nonlocal total
        paths = [r.path for r in batch.collect()]  # at most files_per_batch names
        if not paths:
            return

        def store(rows: DataFrame) -> int:
            folder = os.path.join(out_dir, f"batch_id={batch_id}")
            stamped = rows.withColumn(ingested, F.current_timestamp())
            stamped.write.mode("overwrite").parquet(folder)
            return spark.read.schema(stamped.schema).parquet(folder).count()  # by the footers alone

        usual = reader.read_usual(paths)
        if usual is not None:
            try:
                total += store(usual)
                return
            except Exception as error:
                if OTHER_HEADER not in str(error):
                    raise
        total += store(reader.read(paths))

    stream = (listing.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True).start())
    stream.awaitTermination()
    return total


class _ParquetReader:
    """Files grouped by the schema in their footers; each group is read as it is and brought to the stored one."""

    def __init__(self, spark, src_dir, checkpoint, schema):
        self.spark, self.checkpoint, self.fixed, self.options = spark, checkpoint, schema, {"basePath": src_dir}

    def read_usual(self, paths: Sequence[str]) -> DataFrame | None:
        """All files at once where their footers agree with each other and with the stored schema."""
        known = self.fixed or load_schema(self.spark, self.checkpoint)
        if known is None:
            return None
        try:
            rows = self.spark.read.options(**self.options, mergeSchema=True).parquet(*paths)
        except AnalysisException as error:
            if error.getCondition() != "CANNOT_MERGE_SCHEMAS":
                raise
            return None
        kinds = {f.name: f.dataType for f in known.fields}
        return self._rows(rows, known) if all(kinds.get(f.name) == f.dataType for f in rows.schema.fields) else None

    def read(self, paths: Sequence[str]) -> DataFrame:
        groups: dict[str, list[str]] = {}
        with ThreadPool(8) as pool:  # one footer a file, of at most files_per_batch files
            footers = pool.map(lambda p: self.spark.read.options(**self.options).parquet(p).schema, paths)
        for path, footer in sorted(zip(paths, footers), key=lambda x: x[0]):
            groups.setdefault(footer.json(), []).append(path)
        schemas = [T.StructType.fromJson(json.loads(body)) for body in groups]
        known = start = self.fixed or load_schema(self.spark, self.checkpoint)
        for seen in schemas if self.fixed is None else ():
            known = seen if known is None else widen(known, seen) or known
        if known is not start:
            save_schema(self.spark, self.checkpoint, known)
            if start is not None:
                raise SchemaWidened(f"new columns {known.names[len(start.names):]}")
        parts = [self._rows(self.spark.read.options(**self.options).parquet(*same), known) for same in groups.values()]
        return reduce(DataFrame.unionByName, parts)

    def _rows(self, rows: DataFrame, known: T.StructType) -> DataFrame:
        return rescue_types(rows.withColumn(SOURCE, F.col("_metadata.file_path")), known, RESCUED)


class _CsvReader:
    def __init__(self, spark, src_dir, checkpoint, schema, rescue, multiline, sampling):
        self.spark, self.checkpoint, self.rescue = spark, checkpoint, rescue
        self.options = {**CSV_TEXT, "multiLine": multiline, "basePath": src_dir}
        self.sampling = sampling
        self.fixed = schema

    def _infer(self, paths: Sequence[str]) -> T.StructType:
        if self.options["multiLine"]:
            found = multiline.records(self.spark, paths, self.options["basePath"])
            fields = self.spark.read.options(**CSV_TEXT, multiLine=True).csv(paths[0]).columns
            folders = [f for f in found.schema.fields if not f.name.startswith("__")]
            texts = multiline.parsed(found, fields, MALFORMED)
            if self.sampling < 1:
                texts = texts.sample(self.sampling, seed=0)
            return T.StructType([*multiline.infer(texts, fields).fields, *folders])
        return self.spark.read.options(
            **self.options, inferSchema=True, samplingRatio=self.sampling).csv(paths).schema

    def read_usual(self, paths: Sequence[str]) -> DataFrame | None:
        """All files under the known columns in one pass; Spark rejects any other header."""
        known = self.fixed or load_schema(self.spark, self.checkpoint)
        if known is None or self.options["multiLine"]:
            return None
        listed = self.spark.read.options(**self.options).csv(list(paths)).columns
        header = [c for c in listed if c in known.names]
        if header != listed:
            return None
        return self._rows(header, paths, known, check=True)

    def read(self, paths: Sequence[str]) -> DataFrame:
        """Files grouped by their headers; a first look at every file finds those."""
        groups = self._by_header(paths)
        known = self.fixed or load_schema(self.spark, self.checkpoint)
        if self.fixed is None:
            start = known
            for same_header in groups.values():
                if known is None or not set(self._names(same_header)) <= set(known.names):
                    seen = self._infer(same_header)
                    known = seen if known is None else widen(known, seen) or known
            if start is None:
                save_schema(self.spark, self.checkpoint, known)
            elif known is not start:
                save_schema(self.spark, self.checkpoint, known)
                raise SchemaWidened(f"new columns {known.names[len(start.names):]}")
        result = None
        for header, same_header in groups.items():
            part = self._rows(header, same_header, known)
            result = part if result is None else result.unionByName(
                part, allowMissingColumns=True)
        return result

    def _names(self, paths: Sequence[str]) -> list[str]:
        return self.spark.read.options(**self.options).csv(paths[0]).columns

    def _by_header(self, paths: Sequence[str]) -> dict[tuple, list[str]]:
        """Files by header line: a task for each file, which stops at the first line."""
        one_file_each = {"spark.sql.files.maxPartitionBytes": str(1 << 40), "spark.sql.files.openCostInBytes": str(1 << 40)}
        before = {k: self.spark.conf.get(k) for k in one_file_each}

        def first(batches):
            for batch in batches:
                if batch.num_rows:
                    yield batch.slice(0, 1)
                    return

        try:
            for k, v in one_file_each.items():
                self.spark.conf.set(k, v)
            lines = self.spark.read.text(list(paths)).select(
                F.col("_metadata.file_path").alias("path"), F.col("value").alias("header"))
            firsts = lines.mapInArrow(first, "path string, header string").collect()  # one row per file of the batch
        finally:
            for k, v in before.items():
                self.spark.conf.set(k, v)
        groups: dict[str, list[str]] = {}
        for row in sorted(firsts):
            groups.setdefault(row.header, []).append(row.path)
        return {tuple(self._names(group)): group for group in groups.values()}

    def _rows(self, header: Sequence[str], paths: Sequence[str], known: T.StructType,
              check: bool = False) -> DataFrame:
        in_files = self.spark.read.options(header=True, escape='"',
                                           multiLine=self.options["multiLine"]).csv(paths[0])
        fields = [c for c in header if c in in_files.columns]  # the others come from folders
        texts = T.StructType([T.StructField(c, T.StringType()) for c in [*fields, MALFORMED]])
        if self.options["multiLine"]:  # by many tasks, also within a file
            found = multiline.records(self.spark, paths, self.options["basePath"])
            rows = multiline.parsed(found, fields, MALFORMED).withColumnRenamed("__path", SOURCE)
        else:
            rows = (self.spark.read.schema(texts)
                    .options(**self.options, columnNameOfCorruptRecord=MALFORMED,
                             enforceSchema=not check)
                    .csv(list(paths)).withColumn(SOURCE, F.col("_metadata.file_path")))
        if not self.rescue:
            return rescue_cast(rows, known, RESCUED, MALFORMED).drop(RESCUED)
        return rescue_cast(rows, known, RESCUED, MALFORMED)
