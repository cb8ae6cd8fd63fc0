"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import scratch

MOST_ROUNDS = 60


def _store(edges: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again, which cuts the lineage and survives lost executors."""
    folder = scratch(edges.sparkSession, label)
    edges.write.parquet(folder)
    return edges.sparkSession.read.schema(edges.schema).parquet(folder)


def components(links: DataFrame) -> DataFrame:
    """(``id``, ``component``) for every id that occurs in the link columns ``a`` and ``b``.

    ``component`` is the smallest id that can be reached. Each round hangs the neighbours of an id
    below the smallest one; the number of rounds grows with the logarithm of the longest path. A hub
    with very many links is a partial minimum and a join that AQE splits, never one task's list.
    Null ends are left out, loops give the id itself, repeated links count once.
    """
    edges = links.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    ids = edges.select(F.explode(F.array("a", "b")).alias("id"))
    edges = _store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "links")
    state = None
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: larger neighbours to the smallest one
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = _store(large, "large-star")
        # small star: smaller neighbours, and the id itself, to the smallest one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = _store(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            found = edges.groupBy("a").agg(F.min("b").alias("m"))
            return (ids.distinct().join(found, F.col("id") == F.col("a"), "left")
                    .select("id", F.coalesce("m", "id").alias("component")))
        state = now
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
