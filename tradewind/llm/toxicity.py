"""Toxicity by a chain of linear classifiers over the words of a text.

Categories are predicted one after another. The model of each category sees which telling features
a text holds, words and beginnings of words (so that compounds and endings do not hide a word), and
the probabilities of the categories before it. While fitting, those probabilities come from models
that have not seen the row (out of fold), as they will when new texts are scored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.words import NO_LETTER, Block, blocks, mix, split_words, word_starts

# Bounds of the labelled sample that is fitted on the driver.
ROWS_PER_CLASS = 2500
LONGEST_SAMPLE = 32768
N_FEATURES = 128        # telling features for each category
STARTS = range(5, 10)   # bytes of the beginnings of words
FOLDS = 4
RIDGE = 0.3
FILTER_BITS = 20

# Words that split toxic rows into categories; what makes a row toxic is its label.
CATEGORIES = {
    "insult": ("idiot", "moron", "stupid", "loser", "clown", "fool", "dumb", "imbecile"),
    "contempt": ("trash", "scum", "disgusting", "pathetic", "worthless", "garbage", "filth", "vermin"),
}
LAST = "toxic"


def features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all features of a block and the number of the text of each."""
    words = split_words(block, lower=True, between=NO_LETTER)
    starts, of = word_starts(block, words, STARTS, lower=True)
    number = np.repeat(np.arange(block.n), np.diff(words.of_text))
    return np.concatenate([words.hashes, starts]), np.concatenate([number, number[of]])


@dataclass
class Chain:
    """Categories in order, the sorted hashes of the telling features, and weights for each category.

    Weights: one per feature, one per earlier category, and the constant.
    """
    categories: list[str]
    telling: np.ndarray
    weights: list[np.ndarray]

    @cached_property
    def maybe(self) -> np.ndarray:
        bits = np.zeros(1 << FILTER_BITS, bool)
        bits[self.telling >> np.uint64(64 - FILTER_BITS)] = True
        return bits

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "maybe"}

    def predict(self, held: np.ndarray) -> np.ndarray:
        """Probabilities (rows, categories) from which features each row holds."""
        x = held.astype(np.float64)
        found = np.zeros((len(x), len(self.categories)))
        for i, w in enumerate(self.weights):
            found[:, i] = _sigmoid(np.column_stack([x, found[:, :i], np.ones(len(x))]) @ w)
        return found

    def score(self, block: Block) -> np.ndarray:
        held = np.zeros((block.n, len(self.telling)), bool)
        if len(self.telling):
            hashes, texts = features(block)
            hit = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - FILTER_BITS)])
            at = np.minimum(np.searchsorted(self.telling, hashes[hit]), len(self.telling) - 1)
            same = self.telling[at] == hashes[hit]
            held[texts[hit[same]], at[same]] = True
        return self.predict(held)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the constant (last column) is not shrunk."""
    w, shrink = np.zeros(x.shape[1]), np.full(x.shape[1], RIDGE)
    shrink[-1] = 1e-6
    for _ in range(60):
        p = _sigmoid(x @ w)
        hessian = (x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(hessian, x.T @ (y - p) - shrink * w)
        w += step * min(1.0, 5 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return w


def _telling(sets: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Hashes of the features most bound to any category by the chi-square of presence.

    Each is in two texts at least; of features in the same texts one is enough.
    """
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    found, place = np.unique(every, return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    total = np.bincount(place, minlength=len(found)).astype(float)
    where = np.bincount(place, weights=(mix(row.astype(np.uint64)) >> np.uint64(24)).astype(float),
                        minlength=len(found))
    chosen: dict[float, int] = {}
    n = len(sets)
    for y in labels.T:
        ones = np.bincount(place, weights=y[row], minlength=len(found))
        pos = y.sum()
        gap = ones * n - total * pos
        spread = total * (n - total) * pos * (n - pos)
        chi = np.where((spread > 0) & (total >= 2), gap**2 / np.maximum(spread, 1), 0)
        own: dict[float, int] = {}
        for i in np.lexsort((found, -chi)):
            if chi[i] <= 0 or len(own) == N_FEATURES:
                break
            own.setdefault(where[i], int(i))
        chosen |= {k: i for k, i in own.items() if k not in chosen}
    return found[sorted(chosen.values())]


def fit_sample(rows: list[tuple[str, list[int]]], categories: list[str]) -> Chain:
    """A chain from (text, labels in category order). Without rows every probability is one half."""
    texts = [t for t, _ in rows]
    sets: list[np.ndarray] = []
    for block in blocks(pa.array(texts, pa.string())):
        hashes, of = features(block)
        order = np.lexsort((hashes, of))
        edges = np.searchsorted(of[order], np.arange(block.n + 1))
        sets += [np.unique(hashes[order[a:b]]) for a, b in zip(edges[:-1], edges[1:])]
    labels = np.array([y for _, y in rows], float).reshape(len(rows), len(categories))
    chain = Chain(categories, _telling(sets, labels), [])
    if not rows:
        chain.weights = [np.zeros(i + 1) for i in range(len(categories))]
        return chain
    held = np.stack([np.isin(chain.telling, s) for s in sets]).astype(float)
    fold = np.array([zlib.crc32(t.encode()) for t in texts]) % FOLDS  # copies share a fold
    before = np.zeros((len(rows), 0))
    for i in range(len(categories)):
        x = np.column_stack([held, before, np.ones(len(rows))])
        chain.weights.append(_logistic(x, labels[:, i]))
        out = np.zeros(len(rows))
        for k in range(FOLDS):
            rest = fold != k
            w = _logistic(x[rest], labels[rest, i]) if rest.any() else chain.weights[-1]
            out[~rest] = _sigmoid(x[~rest] @ w)
        before = np.column_stack([before, out])
    return chain


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = LAST) -> Chain:
    """Fit on at most ``rows_per_class`` rows with each label, chosen by a hash of their id.

    Null labels, ids and texts, and texts over ``LONGEST_SAMPLE`` bytes, are left out of fitting. A
    toxic row belongs to the categories whose words it holds; all toxic rows are ``toxic``. Of an id
    with several texts the smallest counts.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")) \
        .where(F.col("doc_id").isNotNull()).distinct()
    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    parts = [known.where(F.col("y") == y).orderBy(*order).limit(rows_per_class) for y in (0, 1)]
    text = F.col(text_col)
    rows = (docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
            .where(text.isNotNull() & (F.octet_length(text) <= LONGEST_SAMPLE))
            .join(F.broadcast(parts[0].unionByName(parts[1])), "doc_id")  # bounded by the limits
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect())  # one row per chosen id
    rows.sort(key=lambda r: (str(r["doc_id"]), r["y"]))
    low = [" " + " ".join(r["text"].lower().split()) for r in rows]
    sample = [(r["text"], [int(bool(r["y"]) and any(w in t for w in words)) for words in CATEGORIES.values()]
               + [int(r["y"])]) for r, t in zip(rows, low)]
    return fit_sample(sample, [*CATEGORIES, LAST])


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``p_<category>`` for each category of the chain.

    Null counts as empty; whole texts are read; the order of words and repetitions do not matter.
    """
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                found = chain.score(block)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.n), *(pa.array(p) for p in found.T)],
                    names=["doc_id", *names])
    kind = docs.schema[id_col].dataType.simpleString()
    shape = ", ".join([f"doc_id {kind}", *(f"{n} double" for n in names)])
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, shape))
