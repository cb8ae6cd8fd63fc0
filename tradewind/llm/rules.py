"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements with one bit per
failed rule. Policies are versioned sets of bits: ``decide`` applies one to a stored ledger and
``ablation`` compares many, both by bit operations alone, without reading a text again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.words import blocks, returning, split_words, windows

REPEAT_WORDS = 8

# Rule names in bit order. Bits are never reused: a changed rule gets a new name and the next bit.
RULES = (
    "few_words",            # fewer than 20 words
    "repeated_windows",     # over 30 % of the words stand in repeated 8-word windows
    "many_symbols",         # over one symbol in ten code points of the words
    "duplicate_lines",      # over 30 % of the lines with words repeat an earlier one
    "short_words",          # mean word under 2 code points
    "long_words",           # mean word over 25 code points
    "repeated_words",       # over 40 % of the words equal the word before them
    "shouting",             # over half of the A-Z, a-z letters are capitals, with 20 letters or more
)
BIT = {name: 1 << i for i, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named version of the rules that reject a document."""
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
# Lists and refrains repeat lines in good documents too, so only the strict policy rejects them.
STANDARD = Policy("standard", 1, tuple(r for r in RULES if r != "duplicate_lines"))
STRICT = Policy("strict", 1, RULES)

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
          "n_repeat_words long, n_doubled_words long, n_letters long, n_capitals long, failed long")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_LETTER = _CAPITAL.copy()
_LETTER[97:123] = True
_WHITE = b" \t\n\x0b\x0c\r"


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(keys: np.ndarray, size: int) -> int:
    """Words covered by windows whose key occurs more than once."""
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    hit = np.flatnonzero(np.isin(keys, twice))
    edge = np.zeros(len(keys) + size, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    found = [x for x in text.split(b"\n") if x.strip(_WHITE)]
    return len(found), len(found) - len(set(found))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column(1)):
            words = split_words(block, lower=False)
            keys = windows(words.hashes, REPEAT_WORDS)
            n = np.diff(words.of_text)
            inside = np.zeros(len(block.data) + 1, np.int8)
            np.add.at(inside, words.starts, 1)
            np.add.at(inside, words.ends, -1)
            inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
            chars = _sums(inside & ((block.data & 0xC0) != 0x80), block.offsets)
            symbols = _sums(_SYMBOL[block.data], block.offsets)
            letters = _sums(_LETTER[block.data], block.offsets)
            capitals = _sums(_CAPITAL[block.data], block.offsets)
            repeat, doubled = np.zeros(block.n, np.int64), np.zeros(block.n, np.int64)
            lines = np.zeros((block.n, 2), np.int64)
            for i in range(block.n):
                a, b = words.of_text[i], words.of_text[i + 1]
                if b - a > REPEAT_WORDS:
                    repeat[i] = _repeated(keys[a:b - REPEAT_WORDS + 1], REPEAT_WORDS)
                if b - a > 1:
                    doubled[i] = (words.hashes[a + 1:b] == words.hashes[a:b - 1]).sum()
                lines[i] = _lines(block.text(i))
            failed = sum(flag.astype(np.int64) << i for i, flag in enumerate((
                n < 20, 100 * repeat > 30 * n, 10 * symbols > chars, 100 * lines[:, 1] > 30 * lines[:, 0],
                chars < 2 * n, chars > 25 * n, 100 * doubled > 40 * n,
                (letters >= 20) & (2 * capitals > letters))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(block.first, block.n),
                 *map(pa.array, (n, chars, symbols, lines[:, 0], lines[:, 1], repeat, doubled, letters,
                                 capitals, failed))],
                names=["doc_id", *[x.split()[0] for x in SCHEMA.split(", ")]])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, the measurements, and ``failed`` with a bit per failed rule.

    A null text has no words and fails ``few_words`` only; repeated rows and null ids give a row
    each; an empty table gives an empty ledger. Lines are cut at ``\\n`` and words at white space;
    whole texts are read, in blocks (see ``words``).
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(returning(_measure), f"doc_id {kind}, {SCHEMA}"))


def keep(docs: DataFrame, policy: Policy, text_col: str = "text") -> DataFrame:
    """The rows of the input that fail no rule of the policy, with all their columns and without a shuffle.

    Each row is judged by its own text, so null and repeated ids need no care.
    """
    mask, place = policy.mask, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = pa.array(np.arange(batch.num_rows))
            judged = list(_measure(iter([pa.RecordBatch.from_arrays([row, batch.column(place)], names=["r", "t"])])))
            if judged:
                failed = np.concatenate([j.column("failed").to_numpy() for j in judged])
                yield batch.filter(pa.array(failed & mask == 0))

    return docs.mapInArrow(returning(run), docs.schema)


def decide(rows: DataFrame, policy: Policy) -> DataFrame:
    """Add ``kept``: no rule of the policy failed. Works on any stored ledger."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0)


def ablation(rows: DataFrame, policies: list[Policy]) -> DataFrame:
    """What each rule adds to each policy, from bits: one row per (policy, version, rule).

    ``n_docs``, ``n_rejected`` by the policy, ``n_failed`` by the rule and ``n_only``, the
    documents that leaving out this rule would let in. The ledger shrinks to one row per bit
    pattern before anything else happens; there are at most 2**len(RULES) of those.
    """
    spark = rows.sparkSession
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    terms = spark.createDataFrame(
        [(p.name, p.version, r, p.mask, BIT[r]) for p in policies for r in p.rules],
        "policy string, version int, rule string, mask long, bit long")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    count = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    # both sides are bounded: the patterns by the number of rules, the terms by the policies
    return (terms.join(F.broadcast(patterns), F.col("failed") >= 0, "left")
            .groupBy("policy", "version", "rule").agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_docs"), count(hit != 0).alias("n_rejected"),
                count(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
                count(hit == F.col("bit")).alias("n_only")))
