"""Quality classifier by compression: two zstandard dictionaries and a calibrated difference.

One dictionary is trained on good, one on bad labelled text. Each text is cut into pieces of
``PIECE`` bytes, so that the dictionaries stay the nearest context all through a long text, and
every piece is compressed with both. The difference of the summed sizes over their sum, with the
better size over the plain one, goes through a logistic curve fitted on labelled rows that neither
dictionary has seen.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 2048
DICTIONARY = 65536
LEVEL = 3
# Bounds of the labelled sample that is fitted on the driver.
ROWS_PER_CLASS = 3000
LONGEST_SAMPLE = 32768


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def pieces(data: bytes) -> list[bytes]:
    return [data[i:i + PIECE] for i in range(0, len(data), PIECE)]


def train(samples: list[bytes]) -> bytes:
    """A dictionary of the samples; too few to train on are used as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


@dataclass
class Model:
    """``dictionaries``: bad, good. ``weights``: of the standardised features and the constant."""
    dictionaries: tuple[bytes, bytes]
    weights: list[float]
    centre: list[float]
    scale: list[float]
    rate: float
    _tools: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_tools": []}

    def features(self, data: bytes) -> tuple[float, float]:
        if not self._tools:
            for raw in self.dictionaries:
                known = zstandard.ZstdCompressionDict(raw)
                known.precompute_compress(level=LEVEL)
                self._tools.append(zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False))
        cut = pieces(data)
        bad, good = (sum(len(tool.compress(p)) for p in cut) for tool in self._tools)
        return (bad - good) / max(1, bad + good), math.log((min(bad, good) + 8) / (len(data) + 8))

    def score(self, data: bytes) -> float:
        """Chance of label 1; the share of label 1 in the fitting sample for an empty text."""
        if not data or not self.weights:
            return self.rate
        x = (np.array(self.features(data)) - self.centre) / self.scale
        return float(1 / (1 + np.exp(-(x @ self.weights[:-1] + self.weights[-1]))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method; the ridge keeps separable samples finite."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)),
                               x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_sample(rows: list[tuple[bytes, int]]) -> Model:
    """Every other row goes into the dictionaries, the rest calibrates. Without both labels in
    both halves the model gives everybody the share of label 1 (one half if there are no rows)."""
    rate = float(np.mean([y for _, y in rows])) if rows else 0.5
    parts = rows[::2], rows[1::2]
    if any({y for _, y in part} != {0, 1} for part in parts):
        return Model((b"", b""), [], [], [], rate)
    dictionaries = tuple(train([p for text, y in parts[0] if y == label for p in pieces(text) if len(p) >= 16])
                         for label in (0, 1))
    model = Model(dictionaries, [], [], [], rate)
    x = np.array([model.features(text) for text, _ in parts[1]])
    y = np.array([label for _, label in parts[1]], float)
    centre, scale = x.mean(0), x.std(0) + 1e-9
    weights = _logistic(np.column_stack([(x - centre) / scale, np.ones(len(x))]), y)
    return Model(dictionaries, weights.tolist(), centre.tolist(), scale.tolist(), rate)


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on at most ``rows_per_class`` labelled rows of each class, chosen by a hash of their id.

    Held-out ids are left out, and so are null, empty and over ``LONGEST_SAMPLE`` byte texts, which
    bounds what the driver holds. Of an id labelled both ways, both labels count; of an id with
    several texts, the smallest.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")) \
        .where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).distinct()
    order = [F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id")]
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("y") == label).orderBy(*order).limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    text = F.col(text_col)
    found = (docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
             .where(text.isNotNull() & F.octet_length(text).between(1, LONGEST_SAMPLE))
             .join(F.broadcast(chosen), "doc_id")  # bounded by the limits above
             .groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect())  # one row per chosen id
    found.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), str(r["doc_id"]), r["y"]))
    return fit_sample([(r["text"].encode(), r["y"]) for r in found])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``score``. Null counts as empty; whole texts are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score((text.as_py() or "").encode()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())],
                                             names=["doc_id", "score"])
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, score double"))
