"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. None of them depends on the size of the
# cluster: partition counts are left to AQE, which starts from many small
# shuffle blocks and merges them to the advisory size.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more exchange downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # long texts would make a batch of the default row count very large
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

# Narrow rows of tables take 20 to 30 times their stored or shuffled bytes when a
# task sorts or joins them. What one task takes in is therefore a fraction of Spark's
# own sizes, so that its memory stays the same however large the tables are.
TABLE_CONF = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # a task still reads as many small files as with Spark's own sizes
    "spark.sql.files.openCostInBytes": "512k",
    # tables in many parts: a task lists many of their folders, not one
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}
# Of files that flows read and tables that they store: about two thirds of the bytes of Spark's own choice
STORED_CODEC = "zstd"
# Shuffles of a cluster begin with at least so many partitions, of which AQE merges the small ones
INITIAL_PARTITIONS = 400


def tune(spark: SparkSession, conf: dict[str, str] = RUNTIME_CONF) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in conf.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def tune_tables(spark: SparkSession) -> SparkSession:
    """``tune`` for jobs on tables: tasks of bounded input."""
    conf = {**RUNTIME_CONF, **TABLE_CONF}
    if not spark.sparkContext.master.startswith("local["):
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            max(INITIAL_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return tune(spark, conf)


def local_session(app: str = "tradewind", cores: int | str = "*", memory: str = "8g",
                  shuffle_partitions: int = 8, conf: dict[str, str] | None = None
                  ) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tradewind-wh-"))
    )
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own, since there the
    driver and the executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tradewind-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")
