"""URL filters by a cascade of Bloom filters, in DataFrame operations only.

A list holds (host, path) keys. A key fits its host and all subdomains, and every path that starts
with its own. The universe is every key that some url of the corpus could be listed under, so a
cascade over it is exact: level 1 encodes the listed keys, level 2 the other keys of the universe
that level 1 lets through, level 3 the listed keys that level 2 lets through, and so on until a
level lets nothing wrong through. Looking a url up is a test of constant bits: no join, no shuffle.

The filters grow with the list (and the logarithm of the universe), not with the corpus;
``MOST_BITS`` bounds them, since they become constants of the plan.
"""

from __future__ import annotations

import math
import string
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.session import scratch

MOST_BITS = 1 << 23
MOST_LEVELS = 64

# Rules of the registered query, (host, path).
ALLOW = (("org", "/"), ("com", "/fr/"))
BLOCK = (("example.org", "/es/"), ("example.org", "/en/1"), ("com", "/de/"))
# Hosts that are blocked where no rule fits.
BLOCKED_HOSTS = (("casino-win.example.net", ""), ("casino-win.example.com", ""), ("spam-farm.example.org", ""),
                 ("spam-farm.example.net", ""), ("spam-farm.example.com", ""))


def host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def shapes(keys: list[tuple[str, str]]) -> list[tuple[int, int]]:
    """The (host labels, path characters) of a list, longest key first."""
    return sorted({(h.count(".") + 1, len(p)) for h, p in keys}, reverse=True)


def candidates(host_col: Column, path_col: Column, of: list[tuple[int, int]]) -> Column:
    """The keys a url could be listed under: for each shape, that end of its host and start of its path."""
    labels = F.size(F.split(host_col, r"\.", -1))
    keys = [F.when((labels >= n) & (F.char_length(path_col) >= chars),
                   F.concat(F.substring_index(host_col, ".", -n), F.substring(path_col, 1, chars)))
            for n, chars in of]
    return F.array_compact(F.array(*keys))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its size in bits, number of hashes, and words of 64 bits by place."""
    bits: int
    hashes: int
    words: tuple[int, ...]


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def member(self, key: Column) -> Column:
        """Whether the key is listed; right for every key of the universe the cascade was made over.

        A key leaves at the first level that lacks it: listed if that level has an even number.
        """
        answer = F.lit(len(self.levels) % 2 == 1)
        for number in reversed(range(len(self.levels))):
            answer = F.when(contains(self.levels[number], number, key), answer).otherwise(F.lit(number % 2 == 1))
        return F.when(key.isNull(), F.lit(False)).otherwise(answer)


def places(level_number: int, bits: int, hashes: int, key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level_number), F.lit(i)), F.lit(bits)) for i in range(hashes)]


def contains(level: Level, number: int, key: Column) -> Column:
    if not any(level.words):
        return F.lit(False)
    words = F.expr(f"array({','.join(f'{w}L' if w > -2**63 else '(-9223372036854775807L-1L)' for w in level.words)})")
    found = F.lit(True)
    for at in places(number, level.bits, level.hashes, key):
        # place at is bit at % 64 of word at / 64; the sign bit cannot be had by an arithmetic test
        found = found & (F.getbit(F.element_at(words, (F.floor(at / 64) + 1).cast("int")), (at % 64).cast("int")) == 1)
    return found


def _fill(keys: DataFrame, number: int, n: int, rate: float) -> Level:
    """A filter of the column ``key``; its words are combined before they reach the driver."""
    bits = max(64, math.ceil(n * math.log2(1 / rate) / math.log(2) / 64) * 64)
    if bits > MOST_BITS:
        raise ValueError(f"a filter of {bits} bits is over the bound of {MOST_BITS}: split the list")
    hashes = max(1, round(math.log2(1 / rate)))
    at = F.explode(F.array(*places(number, bits, hashes, F.col("key"))))
    # whether a bit is set, not a sum: two keys may share a place
    rows = (keys.select(at.alias("at")).groupBy(F.floor(F.col("at") / 64).alias("word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 64).cast("int")))
                 .alias("bits"))
            .collect())  # at most bits / 64 rows
    words = {r["word"]: r["bits"] for r in rows}
    return Level(bits, hashes, tuple(words.get(i, 0) for i in range(bits // 64)))


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """A cascade for the keys of ``listed`` over the keys of ``universe`` (one string column ``key`` each).

    Null keys are left out and repeated keys count once. An empty list gives a cascade that lists
    nothing; with an empty universe one level is enough. The universe is read twice, by counting
    and by level 1; what level 1 lets through is written to the shared folder for the rest.
    """
    spark = universe.sparkSession
    listed = listed.select("key").where(F.col("key").isNotNull()).distinct()
    n_listed = listed.count()
    if not n_listed:
        return Cascade(())
    universe = universe.select("key").where(F.col("key").isNotNull())
    n_rest = universe.agg(F.approx_count_distinct("key")).first()[0]
    rate = min(0.5, math.sqrt(0.5) * n_listed / max(1, n_rest))
    levels = [_fill(listed, 0, n_listed, rate)]
    folder = scratch(spark, f"cascade-{uuid.uuid4().hex[:8]}")
    (universe.where(contains(levels[0], 0, F.col("key"))).distinct()
     .join(listed, "key", "left_anti").write.parquet(folder))
    wrong, right = spark.read.schema("key string").parquet(folder), listed
    while len(levels) < MOST_LEVELS:
        n_wrong = wrong.count()
        if not n_wrong:
            return Cascade(tuple(levels))
        number = len(levels)
        levels.append(_fill(wrong, number, n_wrong, 0.5))
        right, wrong = wrong, right.where(contains(levels[-1], number, F.col("key")))
    raise RuntimeError(f"the cascade does not end within {MOST_LEVELS} levels")


def keys_of(spark, pairs: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame([(h + p,) for h, p in pairs], "key string")


def judge(pages: DataFrame, allow: list[tuple[str, str]], block: list[tuple[str, str]],
          blocked_hosts: list[tuple[str, str]] = BLOCKED_HOSTS, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """One row per input row: ``page_id``, ``host``, ``path``, ``rule`` and ``verdict``.

    The longest listed rule wins (null if none fits); without a rule a url is blocked if its host
    is among ``blocked_hosts`` and else allowed. A null url, or one without ``://``, has empty host
    and path. Repeated rows and null ids give a row each. The lists are given as (host, path) pairs
    and must not share a key.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).alias("page_id"), host(F.col(url_col)).alias("host"),
                        path(F.col(url_col)).alias("path"))
    keyed = rows.select("*", candidates(F.col("host"), F.col("path"), shapes([*allow, *block])).alias("keys"),
                        candidates(F.col("host"), F.col("path"), shapes(list(blocked_hosts))).alias("hosts"))
    universe = keyed.select(F.explode(F.concat("keys", "hosts")).alias("key"))
    allowed, blocked, bad = (build(keys_of(spark, list(pairs)), universe)
                             for pairs in (allow, block, blocked_hosts))
    longest = lambda found: F.element_at(F.array_sort(found, lambda a, b: F.char_length(b) - F.char_length(a)), 1)
    rule = F.when(F.size("fits") > 0, longest(F.col("fits")))
    return (keyed
            .withColumn("fits", F.filter("keys", lambda k: allowed.member(k) | blocked.member(k)))
            .withColumn("rule", rule)
            .select("page_id", "host", "path", "rule",
                    F.when(F.col("rule").isNotNull(), blocked.member(F.col("rule")))
                    .otherwise(F.exists("hosts", bad.member)).alias("bad"))
            .select("page_id", "host", "path", "rule",
                    F.when(F.col("bad"), "block").otherwise("allow").alias("verdict")))
