"""SimHash fingerprints of documents, and permuted block tables that search them. All of it is native.

A text's terms are its five-word shingles (lower-cased words between white space; a text of fewer words
is one term), weighted by how often they occur. Each term has a 128-bit hash, of which every bit votes
with the term's weight: a fingerprint's bit is set where more than half of the weight has it set. The
chance that two fingerprints differ in a bit is the angle between the weight vectors over pi, so
``likeness`` is the cosine of the share of differing bits times pi, and 0 beyond a right angle.

``within`` finds all fingerprints in a Hamming radius: with two blocks of bits more than the radius, two
blocks at least are equal, so there is one table for each pair of blocks, keyed by their bits. A pair of
fingerprints counts in the first table that brings it together. Equal fingerprints are one entry with a
number of copies; crowded keys are dealt over tiles of about ``TILE`` entries, each one row, and queries
are compared with whole tiles, so that no pair becomes a row.

A null text is an empty one; texts without words have no votes, fingerprint 0, and are alike. Repeated
rows give one row each. In ``edited``, the next document is the next other one by id (null first), then by
a hash of id and text; of a single document it is itself. Input columns besides id and text are left out.
"""

from __future__ import annotations

import functools
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.session import scratch

WORDS = 5
BITS = 128
RADIUS = 6
TILE = 4096
LANES = (1 << 32) + 1     # bits i and i + 32 of a hash, each counted in its own half of a long
SPACE = " \t\n\x0b\x0c\r"


def _stored(df: DataFrame, label: str) -> DataFrame:
    folder = scratch(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _any(parts: list[Column]) -> Column:
    """All parts by bitwise or, as a tree of little depth."""
    while len(parts) > 1:
        parts = [functools.reduce(Column.bitwiseOR, parts[i:i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]


def fingerprints(texts: DataFrame, by: list[str], text: str = "text") -> DataFrame:
    """Columns ``by`` with the fingerprint of their text as two longs, ``high`` and ``low``.

    The columns ``by`` tell the rows apart.
    """
    bare = F.btrim(F.lower(text), F.lit(SPACE))
    words = texts.select(*by, F.when(bare != "", F.split(bare, f"[{SPACE}]+")).alias("words"))
    places = F.sequence(F.lit(0), F.greatest(F.size("words") - WORDS, F.lit(0)))
    terms = words.select(*by, "words", F.explode_outer(F.when(F.col("words").isNotNull(), places)).alias("at"))
    first = F.when(F.size("words") >= WORDS, F.xxhash64(*[F.get("words", F.col("at") + k) for k in range(WORDS)])
                   ).when(F.col("words").isNotNull(), F.xxhash64("words"))
    hashed = terms.select(*by, first.alias("h0")).withColumn("h1", F.when(F.col("h0").isNotNull(), F.xxhash64("h0")))
    votes = hashed.groupBy(*by).agg(F.count("h0").alias("terms"), *[
        F.sum(F.shiftright(f"h{half}", i).bitwiseAND(F.lit(LANES))).alias(f"v{half}_{i}") for half in (0, 1) for i in range(32)])

    def half(which: int) -> Column:
        low = [F.col(f"v{which}_{i}").bitwiseAND(F.lit((1 << 32) - 1)) for i in range(32)]
        high = [F.shiftrightunsigned(f"v{which}_{i}", 32) for i in range(32)]
        bit = lambda i: F.lit((1 << i) - (1 << 64) * (i == 63))
        return _any([F.when(2 * n > F.col("terms"), bit(i)).otherwise(F.lit(0).cast("long")) for i, n in enumerate(low + high)])

    return votes.select(*by, half(0).alias("high"), half(1).alias("low"))


def shown(high: Column | str, low: Column | str) -> Column:
    """A fingerprint as 32 hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def apart(high: Column, low: Column, high2: Column, low2: Column) -> Column:
    """Number of bits in which two fingerprints differ."""
    return F.bit_count(high.bitwiseXOR(high2)) + F.bit_count(low.bitwiseXOR(low2))


def likeness(high: str, low: str, high2: str, low2: str) -> Column:
    return F.greatest(F.cos(apart(F.col(high), F.col(low), F.col(high2), F.col(low2)) * F.lit(3.141592653589793 / BITS)), F.lit(0.0))


def edited(docs: DataFrame) -> DataFrame:
    """Each different document with its successor and its edited text.

    Of (``doc_id``, ``text``): ``key``, ``doc_id``, ``copies``, ``n_chars``, ``text``, ``next_key``, and
    ``edited``, in which the next document's beginning stands for the last fourth. Only keys and lengths
    are sorted; texts move once, the beginnings of texts once more.
    """
    text = F.coalesce("text", F.lit(""))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text)
    rows = docs.select(F.unhex(F.md5(named)).alias("key"), "doc_id", text.alias("text"))
    slim = (rows.select("key", "doc_id", F.char_length("text").cast("long").alias("n_chars"))
            .groupBy("key", "doc_id", "n_chars").agg(F.count(F.lit(1)).alias("copies")))
    order = slim.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key")
    order = _stored(order.select("*", F.monotonically_increasing_id().alias("place")), "document-order")
    # one row per sorted partition: where it ends, and where the next one begins
    parts = order.groupBy(F.shiftright("place", 33).alias("part")).agg(F.min("place").alias("first"), F.max("place").alias("end"))
    along = Window.orderBy("part")
    parts = parts.select("end", F.coalesce(F.lead("first").over(along), F.min("first").over(
        along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("jump"))
    ahead = (order.join(parts, order["place"] == parts["end"], "left")
             .select("key", "n_chars", F.coalesce("jump", F.col("place") + 1).alias("next_place")))
    own = order.select(F.col("key").alias("next_key"), F.col("place").alias("next_place"), "doc_id", "copies",
                       F.col("n_chars").alias("next_chars"))
    links = _stored(ahead.join(own, "next_place").select(
        "key", "next_key", "doc_id", "copies", "next_chars", F.floor(F.col("n_chars") / 4).cast("int").alias("take")), "document-links")
    # what each document has to give to the one before it
    gives = links.select(F.col("next_key").alias("__key"), F.col("key").alias("to"), "take", "doc_id", "copies",
                         F.col("next_chars").alias("n_chars"))
    takes = links.select("key", "next_key", F.col("take").alias("own_take"))
    known = rows.select("key", "text").join(gives, F.col("key") == F.col("__key")).drop("__key")
    heads = (known.select(F.col("to").alias("__to"), F.expr("left(text, take)").alias("head"))
             .groupBy("__to").agg(F.first("head").alias("head")))
    whole = known.join(heads, F.col("key") == F.col("__to")).join(takes, "key")
    cut = F.concat(F.expr("left(text, int(n_chars) - own_take)"), F.col("head"))
    return whole.select("key", "doc_id", "copies", "n_chars", "text", "next_key", cut.alias("edited"))


def compare(docs: DataFrame) -> DataFrame:
    """The documents of ``edited`` without their texts, with the digest of the edited one and all fingerprints.

    ``high`` and ``low`` are the document's own, with ``edited_`` those of its edited text, with ``next_``
    those of its successor.
    """
    kept = ["key", "doc_id", "copies", "n_chars", "next_key", "edited_sha256"]
    both = edited(docs).withColumn("edited_sha256", F.sha2("edited", 256)).select(*kept, F.inline(F.array(
        F.struct(F.lit(False).alias("is_edited"), "text"), F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("text")))))
    prints = fingerprints(both, [*kept, "is_edited"])
    of = lambda c, e, name: F.max(F.when(F.col("is_edited") == e, F.col(c))).alias(name)
    prints = _stored(prints.groupBy(*kept).agg(of("high", False, "high"), of("low", False, "low"), of(
        "high", True, "edited_high"), of("low", True, "edited_low")), "prints")
    after = prints.select(F.col("key").alias("next_key"), F.col("high").alias("next_high"), F.col("low").alias("next_low"))
    return prints.join(after, "next_key")


def _tables(high: str, low: str, radius: int) -> Column:
    """(table, key) of a fingerprint for each pair of blocks."""
    found = []
    for table, (a, b) in enumerate(combinations(range(radius + 2), 2)):
        parts = [F.col(c).bitwiseAND(F.lit(m)) for x in (a, b) for c, m in zip((high, low), _mask(x, radius))]
        found.append(F.struct(F.lit(table).alias("table"), F.xxhash64(*parts).alias("bucket")))
    return F.array(*found)


def _mask(block: int, radius: int) -> tuple[int, int]:
    """The bits of a block, in both longs."""
    edges = [BITS * k // (radius + 2) for k in range(radius + 3)]
    bits = ((1 << edges[block + 1]) - 1) ^ ((1 << edges[block]) - 1)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return signed(bits >> 64), signed(bits & ((1 << 64) - 1))


def within(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Number of ``prints`` in the radius of each different query, as ``n_near``.

    Both have ``high`` and ``low``; a row of ``prints`` counts ``copies`` times.
    """
    wanted = queries.select("high", "low").distinct()
    asked = _stored(wanted.select("high", "low", F.inline(_tables("high", "low", radius))), "print-queries")
    entries = prints.groupBy("high", "low").agg(F.sum("copies").alias("copies"))
    keyed = entries.select("high", "low", "copies", F.inline(_tables("high", "low", radius)))
    met = _stored(keyed.join(asked.select("table", "bucket").distinct(), ["table", "bucket"], "left_semi"), "print-buckets")
    sizes = met.groupBy("table", "bucket").agg(F.ceil(F.count(F.lit(1)) / tile).cast("long").alias("tiles"))
    tiles = (met.join(sizes, ["table", "bucket"])
             .groupBy("table", "bucket", F.pmod(F.xxhash64("low", "high"), F.col("tiles")).alias("tile"))
             .agg(F.collect_list(F.struct("high", "low", "copies")).alias("entries")))
    clean = lambda e, x: F.lit(True) if x is None else functools.reduce(Column.__and__, [
        e[c].bitwiseXOR(F.col(c)).bitwiseAND(F.lit(m)) == 0 for c, m in zip(("high", "low"), _mask(x, radius)) if m])
    pairs = list(combinations(range(radius + 2), 2))
    both = lambda e, a, b: clean(e, a) & clean(e, b)

    def first_table(e: Column) -> Column:
        """The table in which an entry meets the query first."""
        case = F.when(both(e, *pairs[0]), 0)
        for n, pair in enumerate(pairs[1:], 1):
            case = case.when(both(e, *pair), n)
        return case

    near = F.filter("entries", lambda e: apart(F.col("high"), F.col("low"), e["high"], e["low"]) <= radius)
    once = F.filter("near", lambda e: first_table(e) == F.col("table"))
    counted = (asked.join(tiles, ["table", "bucket"]).select("high", "low", "table", near.alias("near"))
               .select("high", "low", F.aggregate(once, F.lit(0).cast("long"), lambda s, e: s + e["copies"]).alias("n")))
    return counted.groupBy("high", "low").agg(F.sum("n").alias("n_near"))
