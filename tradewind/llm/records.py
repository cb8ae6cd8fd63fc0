"""Token ids as length-delimited binary records with masked checksums and an offset index.

A shard is one file of records; a record is

    length of the payload       8 bytes, little-endian
    masked CRC-32C of those     4 bytes
    payload                     b"ids", one byte with the width of an id (2 or 4), the ids
    masked CRC-32C of it        4 bytes

Shards hold consecutive ranges of document ids in rising order. The index is a Parquet table beside
them with the file, offset and length of each record, so that readers can take records in any
order. Only Spark's commit of the index makes a shard count: a task that is run again writes a file
of another name, and what a lost attempt has left behind is never read.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.checksums import crc32c, masked

MAGIC = b"ids"
FRAME = 16              # bytes of a record besides its payload
GROUP_CHARS = 1 << 21   # characters that are encoded and framed at once
READ_BYTES = 8 << 20    # bytes that are read at once, or one record
CACHED = 1 << 19         # pieces that an encoder keeps, about 60 MB

INDEX = "shard int, file string, doc_id {kind}, offset long, length long, n_tokens long, local_start long"


# After these a full stop or comma would belong to a longer run of signs.
_SIGN_BEFORE_STOP = re.compile(r"[^ a-zß-öø-ÿ0-9][.,] ")
_LATIN = re.compile("[\x00-\u012f\u0131-\u024f]*")


class WordEncoder:
    """Ids of texts by a tokenizers file that lower-cases and drops white space between words.

    Such a tokenizer treats what stands between two spaces or line feeds by itself, so the library
    is asked once for each distinct such piece and not for each occurrence. In Latin texts, case is
    folded and full stops and commas are set apart first, which leaves far fewer pieces. The pieces
    of a group of texts are numbered by Arrow, and their ids are gathered from one array.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.width = 2 if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self._forget()
        probe = ["a 'S b\n'll, c. ÉÉ d.. E, f", "it's, x_. Y .", "Ab,c. D"]
        want = [np.array(self.library.encode(t, add_special_tokens=False).ids, f"<u{self.width}").tobytes() for t in probe]
        if self.encode(probe) != want:
            raise ValueError(f"{path} does not treat words by themselves")

    def _forget(self) -> None:
        """Known pieces by number, where the ids of each begin, and all ids one after the other."""
        self.known: dict[str, int] = {"": 0}
        self.edges = array("q", [0, 0])
        self.ids = array("H" if self.width == 2 else "I")

    def _prepared(self, text: str) -> str:
        text = text.replace("\n", " ")
        if text.isascii() or _LATIN.fullmatch(text):
            # a special token is found in the text as it stands
            text = text if "<|" in text else text.lower()
            if not _SIGN_BEFORE_STOP.search(text):
                return text.replace(". ", " . ").replace(", ", " , ")
        return text

    def _add(self, pieces: list[str], ids: np.ndarray, edges: np.ndarray) -> None:
        """Pieces with their ids, each from its edge to the next one."""
        self.known.update(zip(pieces, range(len(self.edges) - 1, len(self.edges) - 1 + len(pieces))))
        self.edges.frombytes((edges[1:] + len(self.ids)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.astype(f"u{self.width}").tobytes())

    def _learn(self, missing: list[str]) -> None:
        """Words are asked for in one text, of which the library tells the words apart; the rest one by one."""
        words = [m for m in missing if m.isalpha() and _LATIN.fullmatch(m)]
        if words:
            found = self.library.encode(" ".join(words), add_special_tokens=False)
            of = np.array(found.word_ids)
            edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
            if len(edges) == len(words) + 1:
                self._add(words, np.array(found.ids), edges)
        rest = [m for m in missing if m not in self.known]
        if rest:
            each = [e.ids for e in self.library.encode_batch_fast(rest, add_special_tokens=False)]
            self._add(rest, np.array(list(chain.from_iterable(each)), np.int64),
                      np.concatenate([[0], np.cumsum([len(e) for e in each])]))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        cut = pc.split_pattern(pa.array(map(self._prepared, texts), pa.large_string()), " ")
        ends = cut.offsets.to_numpy()
        numbered = cut.values.dictionary_encode()
        distinct, at = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy()
        if len(self.known) > CACHED:
            self._forget()
        missing = [p for p in distinct if p not in self.known]
        if missing:
            self._learn(missing)
        place = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[at]
        edges = np.frombuffer(self.edges, np.int64)
        starts, sizes = edges[place], edges[place + 1] - edges[place]
        behind = np.cumsum(sizes)
        total = int(behind[-1]) if len(behind) else 0
        gather = np.repeat(starts - behind + sizes, sizes) + np.arange(total)
        ids = np.frombuffer(self.ids, f"u{self.width}")[gather].astype(f"<u{self.width}") if total else b""
        borders = np.concatenate([[0], behind])[ends].tolist()
        return [ids[a:b].tobytes() if b > a else b"" for a, b in zip(borders[:-1], borders[1:])]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def frame(payloads: list[bytes]) -> list[bytes]:
    """Records of some payloads."""
    lengths = np.array([len(p) for p in payloads], np.int64)
    data = np.frombuffer(b"".join(payloads), np.uint8)
    starts = np.cumsum(lengths) - lengths
    sums = masked(crc32c(data, starts, lengths))
    heads = lengths.astype("<u8").view(np.uint8)
    eight = np.full(len(payloads), 8, np.int64)
    head_sums = masked(crc32c(heads, np.arange(len(payloads)) * 8, eight))
    return [b"".join((int(n).to_bytes(8, "little"), int(h).to_bytes(4, "little"), p, int(s).to_bytes(4, "little")))
            for n, h, p, s in zip(lengths, head_sums, payloads, sums)]


def unframe(data: bytes, offsets: np.ndarray, lengths: np.ndarray) -> list[memoryview]:
    """Payloads of the records at some offsets, after comparing length and both checksums."""
    raw = np.frombuffer(data, np.uint8)
    for name, at, sizes, stored in (("length", offsets, np.full(len(offsets), 8, np.int64), offsets + 8),
                                    ("payload", offsets + 12, lengths, offsets + 12 + lengths)):
        kept = raw[stored[:, None] + np.arange(4)].copy().view("<u4")[:, 0] if len(stored) else stored
        if (masked(crc32c(raw, at, sizes)) != kept).any():
            raise ValueError(f"wrong {name} checksum")
    if (raw[offsets[:, None] + np.arange(8)].copy().view("<i8")[:, 0] != lengths).any():
        raise ValueError("a record is not as long as the index says")
    view = memoryview(data)
    return [view[a + 12:a + 12 + n] for a, n in zip(offsets.tolist(), lengths.tolist())]


def write(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Write shards and index of all documents in rising order of their id, null ids first.

    Each text's ids are followed by ``end_id``; a null or empty text is ``end_id`` alone. Rows with
    one id are ordered by a hash of their text; equal rows are written as often as they occur.
    ``folder`` must be new, and one that all executors and the driver share.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        lead = MAGIC + bytes([encoder.width])
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.rec"
        store, top = fs.FileSystem.from_uri(folder)
        out, offset, start = None, 0, 0
        try:
            for batch in batches:
                if out is None and batch.num_rows:
                    out = store.open_output_stream(f"{top}/shards/{name}")
                for first, last, texts in _groups(batch.column(1)):
                    payloads = [lead + ids + end for ids in encoder.encode(texts)]
                    records = frame(payloads)
                    out.write(b"".join(records))
                    lengths = np.array([len(p) for p in payloads], np.int64)
                    counts = (lengths - len(lead)) // encoder.width
                    n = last - first
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, shard, np.int32)), pa.array([name] * n, pa.string()),
                         batch.column(0).slice(first, n), pa.array(offset + np.cumsum(lengths + FRAME) - lengths - FRAME),
                         pa.array(lengths), pa.array(counts), pa.array(start + np.cumsum(counts) - counts)],
                        names=["shard", "file", "doc_id", "offset", "length", "n_tokens", "local_start"])
                    offset += int((lengths + FRAME).sum())
                    start += int(counts.sum())
        finally:
            if out is not None:
                out.close()

    store, top = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{top}/shards", recursive=True)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    kind = docs.schema[id_col].dataType.simpleString()
    (rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
     .mapInArrow(run, INDEX.format(kind=kind)).write.parquet(f"{folder}/index"))


def _groups(texts: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    first, found, total = 0, [], 0
    for i, text in enumerate(texts):
        found.append(text.as_py())
        total += len(found[-1])
        if total >= GROUP_CHARS or i == len(texts) - 1:
            yield first, i + 1, found
            first, found, total = i + 1, [], 0


def index(spark: SparkSession, folder: str) -> DataFrame:
    """The index with ``start``, the number of ids in all records before."""
    rows = spark.read.parquet(f"{folder}/index")
    sums = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    # one row per shard file, so a bounded table in one window
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (rows.join(F.broadcast(bases), "shard")
            .select("shard", "file", "doc_id", "offset", "length", "n_tokens",
                    (F.col("base") + F.col("local_start")).alias("start")))


def read(rows: DataFrame, folder: str) -> DataFrame:
    """Records that ``rows`` of the index name, in any order: ``doc_id``, ``start``, ``n_tokens``, ``ids``.

    ``ids`` is binary, unsigned 32-bit little-endian whatever width the file has. Lengths and
    checksums are compared; a damaged record fails the job. No rows give an empty frame.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        for batch in batches:
            names = batch.column("file").to_pylist()
            offsets = batch.column("offset").to_numpy()
            lengths = batch.column("length").to_numpy()
            at = 0
            while at < batch.num_rows:
                end = at + 1  # a run of neighbouring records of one file is read at once
                while (end < batch.num_rows and names[end] == names[at]
                       and offsets[end] == offsets[end - 1] + lengths[end - 1] + FRAME
                       and offsets[end] + lengths[end] - offsets[at] < READ_BYTES):
                    end += 1
                with store.open_input_file(f"{top}/shards/{names[at]}") as f:
                    data = f.read_at(int(offsets[end - 1] + lengths[end - 1] + FRAME - offsets[at]), int(offsets[at]))
                found = [_ids(p) for p in unframe(data, offsets[at:end] - offsets[at], lengths[at:end])]
                part = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("start"), part.column("n_tokens"),
                     pa.array(found, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])
                at = end

    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.select("file", "offset", "length", "doc_id", "start", "n_tokens")
            .mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary"))


def _ids(payload: memoryview) -> bytes:
    if payload[:3] != MAGIC:
        raise ValueError("not a record of ids")
    return np.frombuffer(payload[4:], f"<u{payload[3]}").astype("<u4").tobytes()
