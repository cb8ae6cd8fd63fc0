"""Streams between layers: append flows and keyed change flows."""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tradewind.functions import columns as X
from tradewind.operators import changes
from tradewind.operators.quality import (DROP, FAIL, Rule, apply_expectations, measure_expectations,
                                         observe_expectations, rejected_rows)
from tradewind.plans.silver import ChangeTable
from tradewind.session import STORED_CODEC, scratch, tune
from tradewind.sources import versions as V
from tradewind.streaming.progress import run_to_end

Stage = Callable[[DataFrame], DataFrame]


def stream_of(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A table written by an earlier flow, as a stream of its new rows."""
    stored = spark.read.option("mergeSchema", True).parquet(path)
    reader = spark.readStream.schema(stored.schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_flow(rows: DataFrame, rules: Sequence[Rule], out_dir: str, checkpoint: str,
                rejects_dir: str | None = None) -> dict[str, int]:
    """Appends a stream's rows that pass the drop rules; returns the violation counts.

    Without ``fail`` rules and rejects, the counts are observed while the rows
    are written, at no extra pass. Otherwise each batch is checked before it is
    written to a folder of its own below ``out_dir``: a violated ``fail`` rule
    leaves the table and the checkpoint as they were, and a batch delivered
    again replaces its rows. ``rejects_dir`` takes the rows that drop rules
    turned away, with the names of these rules.
    """
    if rejects_dir is None and not any(r.action == FAIL for r in rules):
        writer = (observe_expectations(rows, rules, "rules").writeStream.format("parquet")
                  .option("path", out_dir).option("checkpointLocation", checkpoint)
                  .outputMode("append").trigger(availableNow=True))
        _, seen = run_to_end(rows.sparkSession, writer, observed="rules")
        return {r.name: seen.get(r.name, 0) for r in rules}

    totals = {r.name: 0 for r in rules}

    def take(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            kept, counts = apply_expectations(held, rules)
            kept.write.mode("overwrite").parquet(os.path.join(out_dir, f"batch_id={batch_id}"))
            if rejects_dir is not None and any(counts[r.name] for r in rules if r.action == DROP):
                (rejected_rows(held, rules).write.mode("overwrite")
                 .parquet(os.path.join(rejects_dir, f"batch_id={batch_id}")))
        finally:
            held.unpersist()
        for name, violations in counts.items():
            totals[name] += violations

    (rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return totals


def insert_flow(spark: SparkSession, source: str, keys: Sequence[str], out_dir: str, checkpoint: str,
                read: Stage = lambda rows: rows) -> list[int]:
    """Appends the rows that new versions of a keyed table added, each once; returns these versions.

    A version counts by the keys it holds and the one before it did not: rows
    that it rewrote or changed are left out, and so is a whole version that a
    restore or another number of buckets published. Only the parts that a
    version wrote are read, now and as they were. ``read`` turns stored rows
    into plain ones, as ``changes.scd1_rows`` for a type 1 table. A version owns
    its folder of the output, so one that is looked at again adds nothing twice.
    """
    taken: list[int] = []

    def take(batch: DataFrame, batch_id: int) -> None:
        for row in batch.filter(F.col("restored").isNull()).orderBy("version").collect():  # a row for each new version
            parts = [b for b, v in row.placed.items() if v == row.version]
            after = V.as_of_version(spark, source, buckets=parts, known=row)
            earlier = V.newest(spark, source, row.version - 1) if row.version else None
            added = after
            if earlier is not None:
                same_split = (earlier.bucket_count, V.UNPARTED in earlier.placed) == (row.bucket_count, V.UNPARTED in row.placed)
                before = V.as_of_version(spark, source, buckets=parts if same_split else None, known=earlier)
                added = changes.same_keys(after, before.select(*keys), keys, "left_anti")
            read(added).write.mode("overwrite").parquet(os.path.join(out_dir, f"version={row.version}"))
            taken.append(row.version)

    (spark.readStream.schema(V.LIST_SCHEMA).parquet(V.list_path(source)).writeStream.foreachBatch(take)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
    return taken


ROWS_PER_BUCKET = 50_000_000
LEAST_BUCKETS = 16
PIECE = "__piece"
ROWS_PER_PIECE = 250_000  # of a type 1 table: what one task sorts and writes to one file
KEY_SLOTS = 1 << 12
# What a batch leaves on disk: files of its shuffles go when the query that made them ends, tables are packed closely
BATCH_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": STORED_CODEC,
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",  # 8 bytes, not 12
}


def buckets_for(rows: int) -> int:
    """Buckets for a table of that many rows: a power of two, so that growth doubles."""
    return min(V.MOST_BUCKETS, max(LEAST_BUCKETS, 1 << max(0, (rows // ROWS_PER_BUCKET)).bit_length()))


def _bucket_count(known: Row | None, buckets: int | None) -> int | None:
    """What the table shall have; None for a new table that goes by the rows of its first batch."""
    if buckets or known is None:
        return buckets
    if (known.total or 0) > 2 * ROWS_PER_BUCKET * known.bucket_count:
        return max(known.bucket_count, buckets_for(known.total))
    return known.bucket_count


def change_flow(spark: SparkSession, bronze: str, stage: Stage, spec: ChangeTable, target: str,
                checkpoint: str, scd_type: int = 1, buckets: int | None = None,
                files_per_batch: int | None = None, max_rows_per_key: int = 2_000_000
                ) -> dict[str, int]:
    """Applies the new rows of a bronze table to a keyed table; returns the rule violations of this run.

    A type 1 table stores, per key, the changes that its values come from; a
    batch is merged into the buckets it touches. A type 2 table grows
    from its open versions: a batch is joined to those of its keys. Only keys
    with a late change, one that is not after all they have seen, are rebuilt
    from their changes, which are kept beside the table in the same buckets.
    Either way the result depends on the set of bronze rows alone, not on how
    they were split into batches.

    The table's own list holds its number of buckets. ``buckets`` (by default a
    number sized to the first batch, doubled as the table grows) counts for a
    new table; another number than the stored one rewrites the table in the new
    buckets first.

    A violated ``fail`` rule stops the flow before anything is written. What the
    other rules found is kept with the table, see ``rule_results``; it is
    written before the batch is published, so a batch that is delivered again
    replaces it.
    """
    flow = os.path.basename(checkpoint.rstrip("/"))
    totals = {r.name: 0 for r in spec.rules}

    def apply(batch: DataFrame, batch_id: int) -> None:
        known = V.newest(spark, target)
        if V.applied_up_to(known, flow) >= batch_id:
            return
        number = _bucket_count(known, buckets)
        tune(batch.sparkSession, BATCH_CONF)  # a session of this stream alone
        staged = stage(batch).persist(StorageLevel.MEMORY_ONLY)  # the rest is read again: bronze has it on disk already
        try:
            def facts(kept: Column) -> list[Column]:
                bucket = F.when(kept, X.key_bucket(spec.keys, number or 1))
                return [F.count_if(kept).alias("__rows"), V.bucket_bits(bucket).alias("__bits")]

            rows, counts, found = measure_expectations(staged, spec.rules, facts)
            if spec.rules:
                results = [(flow, batch_id, r.name, r.action, counts[r.name]) for r in spec.rules]
                (spark.createDataFrame(results, RULE_RESULTS).coalesce(1).write.mode("overwrite")
                 .parquet(os.path.join(_rules(target), f"{flow}-{batch_id}")))
            if found["__rows"]:
                if number is None:
                    number = buckets_for(found["__rows"])
                touched = None if known is None else V.buckets_in(found["__bits"])
                if known is not None and number != known.bucket_count:
                    V.rebucket(spark, target, number)
                    known = V.newest(spark, target)
                if scd_type == 1:
                    written = _apply_type1(rows, touched, found["__rows"], number, known)
                else:
                    written = _apply_type2(rows, touched, batch_id, number, known)
                V.publish(written, target, f"scd{scd_type}", spec.keys, number, touched, flow, batch_id,
                          cluster_by=spec.cluster_by, laid_out=scd_type == 1)
            for name, violations in counts.items():
                totals[name] += violations
        finally:
            staged.unpersist()

    def _apply_type1(rows: DataFrame, touched: list[int] | None, arrived: int, number: int, known: Row | None) -> DataFrame:
        """New and held changes meet in one shuffle, whose pieces are parts of buckets and are written as they are.

        Of its order a change brings there only what its columns do not tell.
        """
        def held(state: DataFrame) -> DataFrame:
            return changes.thin_order(changes.held_changes(state, spec.keys), spec.sequence_by)

        coming = rows
        if _crowded(rows, arrived):  # keys with very many changes are combined by the tasks that read them
            ordered = changes.with_order(rows, spec.keys, spec.sequence_by)
            coming = held(changes.merge_changes(ordered, spec.keys))
        if known is not None:
            stored = V.as_of_version(spark, target, buckets=touched, known=known)
            coming = coming.unionByName(held(stored), allowMissingColumns=True)
        whole = arrived + ((known.total or 0) if known is not None else 0)
        pieces = number * max(1, math.ceil(whole / number / ROWS_PER_PIECE))
        met = coming.withColumn(PIECE, X.key_bucket(spec.keys, pieces)).repartitionById(pieces, F.col(PIECE))
        ordered = changes.full_order(met, spec.sequence_by, [c for c in rows.columns if c not in spec.keys])
        return changes.merge_changes(ordered, [PIECE, *spec.keys]).drop(PIECE)

    def _crowded(rows: DataFrame, arrived: int) -> bool:
        """Whether one key may have more than ``max_rows_per_key`` changes, as counts of their hashes tell."""
        slots = rows.groupBy(X.key_bucket(spec.keys, KEY_SLOTS).alias("slot")).agg(X.rows().alias("n"))
        return slots.agg(F.max("n")).first()[0] > max_rows_per_key + 2 * arrived / KEY_SLOTS

    def _apply_type2(rows: DataFrame, touched: list[int] | None, batch_id: int, number: int, known: Row | None) -> DataFrame:
        """All versions of the touched buckets: those of the batch's keys extended or rebuilt, the others as stored."""
        keyed = rows.withColumn(V.BUCKET, X.key_bucket(spec.keys, number))
        (keyed.hint("rebalance", V.BUCKET).write.mode("overwrite").partitionBy(V.BUCKET)
         .parquet(os.path.join(_history(target), f"bucket_count={number}", f"batch_id={batch_id}")))
        options = {"track_except": spec.track_except, "ignore_null_updates": True}
        if known is None:
            return changes.scd2(rows, spec.keys, spec.sequence_by, max_rows_per_key=max_rows_per_key, **options)
        stored = V.as_of_version(spark, target, buckets=touched, known=known)
        opened = changes.current(V.as_of_version(spark, target, buckets=touched, known=known))
        arriving = rows.select(*spec.keys).distinct()
        late = changes.late_keys(opened, rows, spec.keys, spec.sequence_by, max_rows_per_key)
        folder = scratch(spark, "late-keys")
        late.write.parquet(folder)
        late = spark.read.schema(late.schema).parquet(folder)
        if late.isEmpty():
            extended = changes.extend_scd2(changes.same_keys(opened, arriving, spec.keys, "left_semi"), rows,
                                           spec.keys, spec.sequence_by, **options)
            others = _without_open(stored, arriving)
            return others.unionByName(extended, allowMissingColumns=True)
        timely = changes.same_keys(arriving, late, spec.keys, "left_anti")
        extended = changes.extend_scd2(
            changes.same_keys(opened, timely, spec.keys, "left_semi"),
            changes.same_keys(rows, late, spec.keys, "left_anti"), spec.keys, spec.sequence_by, **options)
        rebuilt = changes.scd2(
            changes.same_keys(_all_changes(touched, batch_id, number), late, spec.keys, "left_semi"), spec.keys,
            spec.sequence_by, max_rows_per_key=max_rows_per_key, **options)
        others = _without_open(changes.same_keys(stored, late, spec.keys, "left_anti"), timely)
        return (others.unionByName(extended, allowMissingColumns=True)
                .unionByName(rebuilt, allowMissingColumns=True))

    def _without_open(stored: DataFrame, keys: DataFrame) -> DataFrame:
        """Stored versions that stay: closed ones, and open ones of other keys."""
        other = {c: f"__k{i}" for i, c in enumerate(spec.keys)}
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in other.items()])
        return stored.join(keys.withColumnsRenamed(other), same & F.col(changes.END).isNull(), "left_anti")

    def _all_changes(touched: list[int], batch_id: int, number: int) -> DataFrame:
        """The kept changes of touched buckets; those that a restore took back stay away."""
        live = V.live_batches(spark, target).filter(F.col("flow") == flow).select("batch_id")
        live = live.union(spark.range(batch_id, batch_id + 1)).distinct()
        # folders of this bucket count are read by bucket, those of an earlier one in full
        same = F.col("bucket_count") == number
        return (spark.read.option("mergeSchema", True).parquet(_history(target))
                .filter(~same | F.col(V.BUCKET).isin(touched))
                .withColumn("batch_id", F.col("batch_id").cast("long"))
                .join(live, "batch_id", "left_semi").drop("batch_id", "bucket_count", V.BUCKET))

    stream = (stream_of(spark, bronze, files_per_batch).writeStream.foreachBatch(apply)
              .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    stream.awaitTermination()
    return totals


RULE_RESULTS = "flow string, batch_id bigint, rule string, action string, violations bigint"


def _rules(target: str) -> str:
    return target.rstrip("/") + "_rules"


def rule_results(spark: SparkSession, target: str) -> DataFrame:
    """(flow, batch_id, rule, action, violations) of every batch a change flow has applied."""
    return spark.read.schema(RULE_RESULTS).option("recursiveFileLookup", True).parquet(_rules(target))


def _history(target: str) -> str:
    return target.rstrip("/") + "_changes"


def read_type1(spark: SparkSession, target: str, keys: Sequence[str],
               version: int | None = None) -> DataFrame:
    return changes.scd1_rows(V.as_of_version(spark, target, version), keys)


def read_type2(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    return V.as_of_version(spark, target, version)
