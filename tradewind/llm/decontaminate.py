"""Benchmark decontamination by pigeonhole edit matching over words.

A test item of m words may differ from a passage in k = floor(``RATE`` * m) words (inserted, left
out or replaced). Cut into k + 1 pieces, at least one piece then stands in the passage unchanged.
Exact piece hits come from hashes of word windows; around each hit the edit distance is verified
with Myers' bit-parallel algorithm, one integer per item, one step per word. Items of under five words
have no budget and are found verbatim only. No item is too short to be searched for: one of a single
common word matches, and ``clean`` removes, every document that holds it, so who wants such items
ignored leaves them out of the items given.

Items are a query set: they are taken in blocks of ``BLOCK_WORDS`` words at most, and each block is
sent to all tasks and run against every document. The corpus is not shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.words import NO_LETTER, Block, Words, blocks, returning, split_words, windows
from tradewind.session import scratch

RATE = 0.2
LEAST_WORDS = 1         # an item without words stands in no passage
BLOCK_WORDS = 1 << 20
FILTER_BITS = 22

SCHEMA = "doc_id {doc}, item_id {item}, distance int, n_item_words int, first_word long, end_word long"


def words_of(texts: list[str | None]) -> list[np.ndarray]:
    """Hashes of the lower-cased words (digits, letters and all beyond ASCII) of each text."""
    found = []
    for block in blocks(pa.array(texts, pa.string())):
        words = split_words(block, lower=True, between=NO_LETTER)
        found += [words.hashes[a:b] for a, b in zip(words.of_text[:-1], words.of_text[1:])]
    return found


def budget(n_words: int) -> int:
    return int(RATE * n_words + 1e-9)


def pieces(n_words: int) -> list[tuple[int, int]]:
    """(offset, words) of the budget-plus-one pieces of an item."""
    count = budget(n_words) + 1
    edges = [n_words * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def best_match(item: np.ndarray | list[int], text: list[int], most: int) -> tuple[int, int, int] | None:
    """(distance, start, end) of the passage of ``text`` nearest to the item, the first of equals.

    None if it is farther than ``most``. Of the starts that give the distance, the longest passage
    that begins and ends with matched words is not searched for: the shortest is taken.
    """
    item = [int(w) for w in item]
    at = _myers(item, text, anchored=False)
    distance, end = min((d, j) for j, d in enumerate(at))
    if distance > most:
        return None
    back = _myers(item[::-1], text[:end][::-1], anchored=True)
    return distance, end - min((d, j) for j, d in enumerate(back))[1], end


def _myers(item: list[int], text: list[int], anchored: bool) -> list[int]:
    """Distances of the whole item to the passages that end at 0, 1, ... words of the text.

    Passages begin anywhere, or at the start of the text if ``anchored``.
    """
    places: dict[int, int] = defaultdict(int)
    for i, word in enumerate(item):
        places[word] |= 1 << i
    full = (1 << len(item)) - 1
    last = 1 << (len(item) - 1)
    up, down, score = full, 0, len(item)
    found = [score]
    for word in text:
        match = places.get(word, 0) | down
        same = (((match & up) + up) ^ up) | match
        rise = down | (full & ~(up | same))
        fall = up & same
        if rise & last:
            score += 1
        elif fall & last:
            score -= 1
        rise = ((rise << 1) | anchored) & full
        up = ((fall << 1) & full) | (full & ~(rise | same))
        down = rise & same
        found.append(score)
    return found


@dataclass
class Items:
    """One block of the query set: ids and word hashes."""
    ids: list
    words: list[np.ndarray]

    @cached_property
    def by_length(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each piece length: sorted hashes, their items and offsets, and a bit filter."""
        found = defaultdict(list)
        for number, words in enumerate(self.words):
            for offset, n in pieces(len(words)):
                found[n].append((int(windows(words[offset:offset + n], n)[0]), number, offset))
        tables = {}
        for n, rows in found.items():
            rows.sort()
            hashes = np.array([r[0] for r in rows], np.uint64)
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[hashes >> np.uint64(64 - FILTER_BITS)] = True
            tables[n] = hashes, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), bits
        return tables

    def __getstate__(self):
        return {"ids": self.ids, "words": self.words}

    def hits(self, words: Words) -> dict[tuple[int, int], list[int]]:
        """By (text, item), where the item would start if nothing before the piece were changed."""
        found = defaultdict(list)
        for n, (hashes, items, offsets, bits) in self.by_length.items():
            keys = windows(words.hashes, n)
            maybe = np.flatnonzero(bits[keys >> np.uint64(64 - FILTER_BITS)])
            texts = np.searchsorted(words.of_text, maybe, side="right") - 1
            inside = maybe + n <= words.of_text[texts + 1]
            maybe, texts = maybe[inside], texts[inside]
            low = np.searchsorted(hashes, keys[maybe], side="left")
            high = np.searchsorted(hashes, keys[maybe], side="right")
            for at, text, a, b in zip(maybe.tolist(), texts.tolist(), low.tolist(), high.tolist()):
                for j in range(a, b):
                    found[text, int(items[j])].append(at - int(offsets[j]))
        return found

    def search(self, block: Block) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, end word): the nearest passage for each item found."""
        words = split_words(block, lower=True, between=NO_LETTER)
        for (text, item), starts in sorted(self.hits(words).items()):
            low, high = int(words.of_text[text]), int(words.of_text[text + 1])
            n = len(self.words[item])
            slack = budget(n)
            best = None
            for a, b in _merged(sorted(set(starts)), slack, n):
                a, b = max(a, low), min(b, high)
                match = best_match(self.words[item], words.hashes[a:b].tolist(), slack)
                if match and (best is None or match[0] < best[0]):
                    best = match[0], match[1] + a - low, match[2] + a - low
                if best and best[0] == 0:
                    break
            if best:
                yield text, item, *best


def _merged(starts: list[int], slack: int, n: int) -> Iterator[tuple[int, int]]:
    """Windows that hold every passage within the budget around the hits, overlapping ones as one."""
    a = b = None
    for start in starts:
        if b is None or start - slack > b:
            if b is not None:
                yield a, b
            a = start - slack
        b = start + n + slack
    yield a, b


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Items]:
    """The query set in blocks. Items without words (null, empty, signs alone) are left out."""
    ids, words, total = [], [], 0
    for row in items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).orderBy("i", "t").toLocalIterator():
        found = words_of([row["t"]])[0]
        if len(found) < LEAST_WORDS:
            continue
        ids.append(row["i"])
        words.append(found.copy())
        total += len(found)
        if total >= BLOCK_WORDS:
            yield Items(ids, words)
            ids, words, total = [], [], 0
    if ids:
        yield Items(ids, words)


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document and item within the budget of one of its passages.

    ``doc_id``, ``item_id``, ``distance`` in words of the nearest passage, ``n_item_words``, and the
    passage's ``first_word`` and ``end_word`` (exclusive). Null and empty texts match nothing;
    repeated documents and items give a row each. With more than one block of items, the rows of
    each block are written to the shared folder, so that the driver holds one block at a time.
    """
    spark = docs.sparkSession
    kind = SCHEMA.format(doc=docs.schema[id_col].dataType.simpleString(),
                         item=items.schema[item_col].dataType.simpleString())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    empty = spark.createDataFrame([], kind)
    item_type = pa.int64() if "item_id bigint" in kind else None

    def search(items: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in blocks(batch.column(1)):
                    found = list(items.search(block))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([block.first + f[0] for f in found], pa.int64())),
                         pa.array([items.ids[f[1]] for f in found], item_type),
                         pa.array([f[2] for f in found], pa.int32()),
                         pa.array([len(items.words[f[1]]) for f in found], pa.int32()),
                         pa.array([f[3] for f in found], pa.int64()), pa.array([f[4] for f in found], pa.int64())],
                        names=["doc_id", "item_id", "distance", "n_item_words", "first_word", "end_word"])
        return rows.mapInArrow(returning(run), kind)

    parts = item_blocks(items, item_col, item_text_col)
    first, second = next(parts, None), next(parts, None)
    if first is None:
        return empty
    if second is None:
        return search(first)
    folder = scratch(spark, "decontaminate")
    for part in (first, second):
        search(part).write.mode("append").parquet(folder)
    for part in parts:
        search(part).write.mode("append").parquet(folder)
    return spark.read.schema(kind).parquet(folder)


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """The rows of the input that no item matches, with all their columns and without a shuffle.

    Each row is judged by its own text. More than one block of items is worked off one block after
    the other, each on what is left, through the shared folder.
    """
    place, schema = docs.columns.index(text_col), docs.schema

    def without(rows: DataFrame, block_of_items: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for block in blocks(batch.column(place)):
                    keep[[block.first + f[0] for f in block_of_items.search(block)]] = False
                yield batch.filter(pa.array(keep))
        return rows.mapInArrow(returning(run), schema)

    folder = None
    for number, part in enumerate(item_blocks(items, item_col, item_text_col)):
        if number:
            folder = folder or scratch(docs.sparkSession, "decontaminated")
            docs.write.parquet(f"{folder}/{number}")
            docs = docs.sparkSession.read.schema(schema).parquet(f"{folder}/{number}")
        docs = without(docs, part)
    return docs
