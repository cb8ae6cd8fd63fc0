"""How far the sources of a language diverge in their use of terms.

A term is a run of letters (A-Z lower-cased, everything beyond ASCII counts as a letter). A language keeps
the V terms that at least ``LEAST_DOCS`` of its documents hold. In a group (a source of a language, or the
language itself) with N occurrences of kept terms, a term with c of them has the share
p = 1 + floor(10^9 (c + 1) / (N + V)); a share p costs floor((p - q)^2 / q) against another group's q.

``pairs`` sums that over all kept terms, for every two sources of a language, in both directions: each
group's (term id, count) arrays are sorted and cut into blocks of terms, and a task co-groups the slices of
some groups in one block. For each unordered pair in it, a galloping intersection finds the terms of both,
which are priced with both counts; terms of one side are priced against the other's share of no occurrence;
those that neither has are only counted (all cost the same). ``telling`` lists a group's dearest own terms.

Counting combines within a task before anything is shuffled, so that neither a hot group nor a frequent
term weighs more than a row for each task. Slices and tasks are bounded by terms of a block and groups of a
tile, whatever the size of a group. Shares are exact while N + V stays below 2.8 * 10^14.

Null text, lang and source count as ''. Repeated rows are documents of their own. Empty texts and sources
without kept terms are groups with counts of 0; in a language without kept terms pairs cost 0 and no term
is listed. Further columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import scratch

LEAST_DOCS = 3
MOST_TERMS = 200
BLOCK_TERMS = 1 << 16       # terms of a language in a block, about
TILE_GROUPS = 16            # groups of a language in a tile, about
HELD = 1 << 18              # counts that a task holds before it hands them on
PIECE = 1 << 20             # bytes of a text that are split at once
SCALE = (31250, 32000)      # 10^9 in two factors, so that no product leaves 64 bits

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTED = "lang string, source string, term string, n long, docs long"
_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def terms_of(text: bytes) -> Counter:
    """Occurrences of the terms of a text in UTF-8."""
    spaced, found, start = text.translate(_LETTERS), Counter(), 0
    while start < len(spaced):
        end = spaced.find(b" ", start + PIECE)
        end = len(spaced) if end < 0 else end
        found.update(spaced[start:end].split())
        start = end
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple, dict[bytes, list[int]]] = {}
    size = 0

    def out():
        for (lang, source), found in held.items():
            rows = len(found)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * rows, pa.string()), pa.array([source] * rows, pa.string()),
                pa.array(list(found), pa.binary()).cast(pa.string()), pa.array([e[0] for e in found.values()], pa.int64()),
                pa.array([e[1] for e in found.values()], pa.int64())], schema=_ARROW)

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
            group = held.setdefault((lang, source), {})
            before = len(group)
            for term, n in terms_of(text.as_py()).items():
                entry = group.get(term)
                if entry is None:
                    group[term] = [n, 1]
                else:
                    entry[0] += n
                    entry[1] += 1
            size += len(group) - before
            if size > HELD:
                yield from out()
                held, size = {}, 0
    yield from out()


def _stored(df: DataFrame, label: str) -> DataFrame:
    folder = scratch(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def share(n: str, total: str) -> Column:
    """p of ``n`` occurrences where N + V is ``total``."""
    scaled = (F.col(n) + 1) * SCALE[0]
    whole = lambda a: F.call_function("div", a, F.col(total))
    return whole(scaled) * SCALE[1] + whole(scaled % F.col(total) * SCALE[1]) + 1


def shares(n: np.ndarray, total: int) -> np.ndarray:
    scaled = (n + 1) * SCALE[0]
    return scaled // total * SCALE[1] + scaled % total * SCALE[1] // total + 1


def cost(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def costs(p, q):
    return (p - q) * (p - q) // q


def shared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both sorted id arrays of the ids they share: the shorter one gallops through the longer."""
    if len(a) > len(b):
        at_b, at_a = shared(b, a)
        return at_a, at_b
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = np.searchsorted(b, a[0]), np.searchsorted(b, a[-1], side="right")
    at = np.searchsorted(b[first:last], a) + first
    met = np.flatnonzero(b[np.minimum(at, len(b) - 1)] == a)
    return met, at[met]


def price(a: tuple, b: tuple) -> tuple[int, int, int]:
    """Costs of a against b and of b against a over the terms that either has, and how many these are.

    A side is its ids, their shares, and its share of no occurrence.
    """
    (ids_a, p, p0), (ids_b, q, q0) = a, b
    at_a, at_b = shared(ids_a, ids_b)
    only_a, only_b = np.ones(len(p), bool), np.ones(len(q), bool)
    only_a[at_a], only_b[at_b] = False, False
    both_p, both_q, lone_p, lone_q = p[at_a], q[at_b], p[only_a], q[only_b]
    ahead = costs(both_p, both_q).sum() + costs(lone_p, q0).sum() + costs(p0, lone_q).sum()
    back = costs(both_q, both_p).sum() + costs(q0, lone_p).sum() + costs(lone_q, p0).sum()
    return int(ahead), int(back), len(p) + len(q) - len(at_a)


PRICED = "lang string, a string, b string, ahead long, back long, either long"


def _price(table: pa.Table) -> pa.Table:
    """All unordered pairs of one (lang, block, tile, tile)."""
    lang, low, high = (table.column(c)[0].as_py() for c in ("lang", "low", "high"))
    sides = []
    for source, tile, total, ids, counts in zip(*(table.column(c) for c in ("source", "tile", "total", "ids", "counts"))):
        n = np.asarray(counts.values, np.int64)
        total = total.as_py()
        sides.append((source.as_py(), tile.as_py(), (np.asarray(ids.values, np.int64), shares(n, total),
                                                     int(shares(np.zeros(1, np.int64), total)[0]))))
    sides.sort(key=lambda s: s[:2])
    rows = [(lang, s, t, *price(x, y)) for k, (s, i, x) in enumerate(sides) for t, j, y in sides[k + 1:]
            if {i, j} == {low, high}]
    names = ("lang", "a", "b", "ahead", "back", "either")
    kinds = (pa.string(),) * 3 + (pa.int64(),) * 3
    return pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=list(names))


class Audit:
    """The counts of a corpus, stored: groups with their totals, and kept terms of each group."""

    def __init__(self, docs: DataFrame):
        plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
        counts = _stored(plain.mapInArrow(_count, COUNTED).groupBy("lang", "source", "term")
                         .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "term-counts")
        kept = (counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                .where(F.col("docs") >= LEAST_DOCS).select("lang", "term", "lang_n"))
        self.kept = _stored(kept.select("*", F.monotonically_increasing_id().alias("id")), "kept-terms")
        self.counts = _stored(counts.select("lang", "source", "term", "n").join(self.kept, ["lang", "term"]), "kept-counts")
        langs = self.kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
        sums = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
        groups = plain.select("lang", "source").distinct().join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
        held = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
        #: lang, source, v, and N + V of the group (total) and of the language (lang_total)
        self.groups = _stored(groups.select("lang", "source", held("v").alias("v"), (held("group_total") + held("v")).alias("total"),
                                            (held("lang_total") + held("v")).alias("lang_total")), "groups")

    def telling(self) -> DataFrame:
        """Kept terms that a group has, and more of than its language: lang, source, item, value."""
        rows = self.counts.join(self.groups, ["lang", "source"])
        p, q = share("n", "total"), share("lang_n", "lang_total")
        return (rows.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
                .select("lang", "source", "item", cost(F.col("p"), F.col("q")).alias("value")))

    def pairs(self, block_terms: int = BLOCK_TERMS, tile_groups: int = TILE_GROUPS) -> DataFrame:
        """Each two different sources of a language, in both directions: lang, source, item, value."""
        most = (self.groups.groupBy("lang").agg(F.max("v").alias("v"), F.count(F.lit(1)).alias("n"))
                .agg(F.max("v"), F.max("n")).first())
        blocks, tiles = (max(1, -(-(m or 0) // size)) for m, size in zip(most, (block_terms, tile_groups)))
        slices = (self.counts.groupBy("lang", "source", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
                  .agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("terms")))
        every = (self.groups.where("v > 0").withColumn("tile", F.pmod(F.xxhash64("source"), F.lit(tiles)))
                 .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
        sides = every.join(slices, ["lang", "source", "block"], "left").select(
            "lang", "source", "block", "tile", "total", F.coalesce("terms.id", F.array().cast("array<long>")).alias("ids"),
            F.coalesce("terms.n", F.array().cast("array<long>")).alias("counts"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))).alias("other"))
        priced = (sides.withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other")).drop("other")
                  .groupBy("lang", "block", "low", "high").applyInArrow(_price, PRICED)
                  .groupBy("lang", "a", "b").agg(*[F.sum(c).alias(c) for c in ("ahead", "back", "either")]))
        own = self.groups.select("lang", F.col("source").alias("a"), "v", "total")
        other = self.groups.select("lang", F.col("source").alias("b"), F.col("total").alias("other_total"))
        p0 = share("none", "total").alias("p0")
        q0 = share("none", "other_total").alias("q0")
        full = (priced.join(own, ["lang", "a"]).join(other, ["lang", "b"]).withColumn("none", F.lit(0).cast("long"))
                .select("*", p0, q0))
        absent = F.col("v") - F.col("either")
        both = full.select("lang", F.inline(F.array(
            F.struct(F.col("a").alias("source"), F.col("b").alias("item"), (F.col("ahead") + absent * cost(F.col("p0"), F.col("q0"))).alias("value")),
            F.struct(F.col("b").alias("source"), F.col("a").alias("item"), (F.col("back") + absent * cost(F.col("q0"), F.col("p0"))).alias("value")))))
        bare = self.groups.where("v = 0").select("lang", "source")
        zero = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source != item")
        return both.unionByName(zero.withColumn("value", F.lit(0).cast("long")))


def ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    """Ranks by value, highest first, then item, within each group."""
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    rows = rows.withColumn("rank", rank)
    if most is not None:
        rows = rows.where(F.col("rank") <= most)
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
