"""CSV records that span lines, cut out of large files by many tasks.

A line break ends a record where the number of quotes before it in the file is
even. A first pass counts the quotes of each split of a file; their running sums
say for every split whether it begins inside a quoted field. With that, each
task cuts its own splits into records; what a record has on both sides of a
border is put together afterwards, from at most two pieces per border.

Quotes must enclose fields, doubled inside them; a single quote mark within a
field that is not quoted itself would count as one that opens.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

RECORD, TAIL, MIDDLE, HEAD = range(4)
BATCH_ROWS = 4096
PLACE = "__path string, __block long, __n long, __kind int, __record string"
INFERRED = ("int", "bigint", "double", "date", "timestamp", "boolean")


def _cut(parts: Sequence[str], schema: T.StructType, pieces: bool):
    """Whole records, or the pieces at the borders of the splits: each is read by a pass of its own."""
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, held, odd, inside, n, place = None, [], False, False, 0, ()
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            for i, (line, path, block, opened) in enumerate(zip(*columns[:4])):
                if at != (path, block):
                    if held and pieces:
                        yield (*at, n, MIDDLE if inside else TAIL, "\n".join(held), *place)
                    at, held, odd, inside, n = (path, block), [], bool(opened), bool(opened), 0
                    place = tuple(c[i] for c in columns[4:])
                held.append(line)
                odd ^= line.count('"') % 2 == 1
                if not odd:
                    record = "\n".join(held) if len(held) > 1 else line
                    filled = bool(record.strip("\r"))
                    if inside:
                        if pieces:
                            yield (*at, n, HEAD, record, *place)
                    elif filled and not pieces:
                        yield (*at, n, RECORD, record, *place)
                    n += filled or inside
                    held, inside = [], False
        if held and pieces:
            yield (*at, n, MIDDLE if inside else TAIL, "\n".join(held), *place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for row in rows(batches):
            found.append(row)
            if len(found) == BATCH_ROWS:
                yield _batch(found, arrow)
                found = []
        if found:
            yield _batch(found, arrow)

    return run


def _batch(found: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)


def records(spark: SparkSession, paths: Sequence[str], base: str | None = None) -> DataFrame:
    """(__path, __block, __n, __record) of all records, headers included, and the columns of the folders.

    ``__block`` and ``__n`` order the records of a file; its header has both 0.
    """
    options = {"basePath": base} if base else {}
    text = spark.read.options(**options, lineSep="\n").text(list(paths))
    parts = [c for c in text.columns if c != "value"]
    lines = text.select("value", F.col("_metadata.file_path").alias("path"),
                        F.col("_metadata.file_block_start").alias("block"), *parts)
    quotes = F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = (lines.groupBy("path", "block").agg(quotes.alias("odd"))
              .select("path", "block", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("opened")))
    # a short row for each split of the files, as many as the scan has tasks; the lines keep their order
    marked = lines.join(F.broadcast(opened), ["path", "block"]).select("value", "path", "block", "opened", *parts)
    fields = [f for f in text.schema.fields if f.name in parts]
    schema = T.StructType([*T._parse_datatype_string(PLACE).fields, *fields])
    whole = marked.mapInArrow(_cut(parts, schema, False), schema).drop("__kind")
    ordered = Window.partitionBy("__path").orderBy("__block", "__n")
    pieces = marked.mapInArrow(_cut(parts, schema, True), schema).withColumn("__first", F.sum((F.col("__kind") == TAIL).cast("int")).over(ordered))
    place = F.struct("__block", "__n", "__record", *parts)
    joined = pieces.groupBy("__path", "__first").agg(F.array_sort(F.collect_list(place)).alias("p"))
    stitched = joined.select("__path", *[F.col("p")[0][c].alias(c) for c in ("__block", "__n")],
                             F.array_join("p.__record", "\n").alias("__record"), *[F.col("p")[0][c].alias(c) for c in parts])
    return whole.unionByName(stitched)


def parsed(found: DataFrame, fields: Sequence[str], malformed: str) -> DataFrame:
    """The records but the headers, with every field as the text it holds.

    ``malformed`` has the whole record where it has another number of fields.
    """
    texts = ", ".join(f"`{c}` string" for c in [*fields, malformed])
    others = [c for c in found.columns if not c.startswith("__")]
    row = F.from_csv("__record", texts, {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": malformed})
    return (found.where((F.col("__block") != 0) | (F.col("__n") != 0))
            .select(row.alias("__row"), F.col("__path"), *others).select("__row.*", "__path", *others))


def infer(texts: DataFrame, fields: Sequence[str]) -> T.StructType:
    """For each text column the first type that all its values can be cast to, else string."""
    held = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()).alias(f"{i}_{kind}")
            for i, c in enumerate(fields) for kind in INFERRED]
    some = [F.count(c).alias(f"{i}_n") for i, c in enumerate(fields)]
    found = texts.agg(*held, *some).first()
    kinds = [next((k for k in INFERRED if found[f"{i}_n"] and not found[f"{i}_{k}"]), "string") for i in range(len(fields))]
    return T.StructType([T.StructField(c, T._parse_datatype_string(k)) for c, k in zip(fields, kinds)])
