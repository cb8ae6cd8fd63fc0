"""Physical layout: partitioned, clustered and compacted copies of a table."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions import columns as X
from tradewind.operators.cuts import quantile_pieces

COMPACT_BYTES = 1 << 27  # of a file: one task reads, sorts and writes it, and its rows take several times the bytes of the file


def write_by_month(df: DataFrame, ts: str, path: str, month: str = "purchase_month",
                   rows_per_file: int = 5_000_000) -> None:
    """One folder per month, which filters on the month prune.

    The rebalance lets AQE cut large months over several tasks and small ones
    together, so a month is neither one giant file nor one file per task.
    """
    (df.withColumn(month, X.month_text(ts)).hint("rebalance", month)
     .write.option("maxRecordsPerFile", rows_per_file)
     .partitionBy(month).mode("overwrite").parquet(path))


def write_clustered(df: DataFrame, path: str, keys: Sequence[str],
                    files: int | None = None) -> None:
    """Files hold narrow ranges of the keys, so their min/max statistics skip well.

    A hash of the row ends the range key, so that one hot value spreads over many files.
    """
    spread = [*keys, F.xxhash64(*df.columns)]
    ranged = (df.repartitionByRange(files, *spread) if files is not None
              else df.repartitionByRange(*spread))
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below a path; only their listing is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(path))
    return files.agg(F.sum("length")).first()[0] or 0


def z_bits(files: int, columns: int) -> int:
    """Bits per column that give several z-values for each file."""
    return max(4, math.ceil(math.log2(8 * files) / columns))


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Interleaved bits of each column's position; text columns take a hash for position."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    found = quantile_pieces(df, [c for c in columns if c not in texts], 1 << bits)
    found |= {c: F.pmod(F.xxhash64(c), F.lit(1 << bits)) for c in texts}
    pieces = [found[c].cast("long") for c in columns]
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for i, piece in enumerate(pieces):
            taken = F.shiftright(piece, bit).bitwiseAND(F.lit(1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(taken, bit * len(pieces) + i))
    return z


def compact(spark: SparkSession, path: str, out_path: str, zorder_by: Sequence[str] = (),
            target_bytes: int = COMPACT_BYTES) -> DataFrame:
    """Rewrites a table into files of about the target size; returns (files, bytes).

    The copy goes to a path of its own: the table is being read while it is written.
    """
    df = spark.read.parquet(path)
    files = max(1, math.ceil(stored_bytes(spark, path) / target_bytes))
    if len(zorder_by) > 1:
        keyed = df.withColumn("__z", z_value(df, zorder_by, z_bits(files, len(zorder_by))))
        # rows of one z-value may still fill several files
        shaped = (keyed.repartitionByRange(files, "__z", F.xxhash64(*df.columns))
                  .sortWithinPartitions("__z").drop("__z"))
    elif zorder_by:
        shaped = df.repartitionByRange(files, *zorder_by, F.xxhash64(*df.columns)).sortWithinPartitions(*zorder_by)
    else:
        shaped = df.repartition(files)
    shaped.write.mode("overwrite").parquet(out_path)
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
               .load(out_path))
    return listing.agg(F.count("path").alias("files"), F.sum("length").alias("bytes"))
