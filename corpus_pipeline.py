"""The corpus pipeline: five filters and edits of ``documents``, each one of the operators in tradewind.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to the
shared folder and reads it again as the next stage's documents, so that a lost executor costs no
more than the stage it worked on. Stages 1 to 4 return the columns of their input. Near duplicates
are told by their texts (a 64-bit hash), so rows with null or repeated ids are rows like others.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import bpe, decontaminate, jaccard, rules, secrets
from tradewind.session import scratch, tune


def _apart(docs: DataFrame, *names: str) -> tuple[DataFrame, list]:
    """The documents with columns of these names renamed, and what selects all columns as they were."""
    taken = {c.lower() for c in docs.columns} | set(names)
    renamed = {}
    for c in docs.columns:
        if c.lower() in names:
            renamed[c] = next(n for n in (f"{c}_{i}" for i in range(len(taken) + 1)) if n.lower() not in taken)
            taken.add(renamed[c].lower())
    return docs.withColumnsRenamed(renamed), [F.col(renamed.get(c, c)).alias(c) for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the standard policy rejects.

    Null, empty and blank texts have too few words and go; repeated rows stay or go alike; texts of any
    length are judged whole.
    """
    return rules.keep(docs, rules.STANDARD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate component, the first by id (no id last) and text hash.

    Null texts and texts without words are no copies of each other and stay; of repeated rows with words
    one stays; texts of any length are compared whole.
    """
    docs, columns = _apart(docs, "__hash", "__told", "__copy", "__best")
    rows = docs.withColumn("__hash", F.xxhash64("text"))
    reach = (jaccard.near_duplicates(rows, "__hash").where(F.col("n_shingles") > 0)
             .groupBy(F.col("doc_id").alias("__hash")).agg(F.min("component_id").alias("group")))
    texts = rows.groupBy("__hash").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))).alias("first"),
        F.count(F.lit(1)).alias("times")).join(reach, "__hash")
    best = texts.groupBy("group").agg(F.min(F.struct("first", "__hash")).alias("best"))
    copy = F.col("__hash") != F.col("best.__hash")
    told = texts.join(best, "group").where(copy | (F.col("times") > 1)).select(
        F.col("__hash").alias("__told"), copy.alias("__copy"), F.col("best.first.id").alias("__best"))
    folder = scratch(spark, "copies")  # read twice, and joined by its real size
    told.write.parquet(folder)
    told, same = spark.read.schema(told.schema).parquet(folder), F.col("__hash") == F.col("__told")
    again = rows.join(told.where(~F.col("__copy")), same).where(F.col("doc_id").eqNullSafe(F.col("__best")))
    return (rows.join(told, same, "left_anti").select(*columns)
            .unionByName(again.dropDuplicates(["__hash"]).select(*columns)))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item.

    Null and empty texts hold none and stay; repeated rows stay or go alike; long texts are searched whole.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind in brackets and ``n_chars`` brought up to date.

    Null and empty texts hold none and stay as they are, as does a null ``n_chars`` of a text without
    secrets; repeated rows are changed alike; long texts are searched whole.
    """
    docs, columns = _apart(docs, "secret_spans", "__held")
    found = secrets.find(docs)
    clean = secrets.redact(found.withColumn("__held", F.size("secret_spans") > 0))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(
            F.col("__held"), F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return clean.select(*columns)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, with the digest of what they decode to.

    Null and empty texts have no ids and the digest of the empty text; repeated rows give a row each; long
    texts are encoded whole. Other columns are left out.
    """
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode(docs, path).withColumn("n_tokens", F.size("ids").cast("long"))
    decoded = bpe.decode(encoded.withColumn("kept_ids", F.col("ids")), path, ids_col="ids", out_col="decoded")
    return decoded.select("doc_id", "n_tokens", F.col("kept_ids").alias("ids"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def _tuned(stage):
    """The stage with the library's session settings, also where it is called by itself."""
    return lambda spark, docs, sf_dir: stage(tune(spark), docs, sf_dir)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", _tuned(quality_rules)),
    ("ngram_jaccard_join", _tuned(near_duplicates)),
    ("benchmark_decontamination", _tuned(benchmark_decontamination)),
    ("secret_scan", _tuned(secret_scan)),
    ("bpe_encode", _tuned(bpe_encode)),
]

# Byte-pair merges and the edit distance are not expressible in SQL: see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES, 1):
        out = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
