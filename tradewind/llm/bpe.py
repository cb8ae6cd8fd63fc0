"""Byte-level BPE as a bounded-lookahead transducer, and its decoder as a byte-to-text state machine.

A merge list fixes how far what follows a text can change its tokens: ``lookahead`` computes the
bound in bytes. The transducer holds the bytes of one pre-token that are not settled yet, and emits
a token once that many bytes follow it, so that its memory depends neither on the text nor on the
length of a pre-token. Pre-tokens are found in windows of fixed size, of which the last piece, and
pieces that begin less than a contraction before the window's end, wait for the next window. The results of short pre-tokens
are kept in a bounded cache, from which those that did not come again leave first.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.words import returning

WINDOW = 1 << 16        # characters of a text that are cut into pre-tokens at once
AHEAD = 3               # characters that decide how a pre-token begins: the longest contraction
STEP = 1 << 12          # bytes of a long pre-token that are settled at once
CACHED = 1 << 17        # pre-tokens in the cache, about 30 MB
CACHED_BYTES = 64       # longest pre-token in the cache
BATCH_IDS = 1 << 21     # ids or characters of an output batch

# Fixed value: how this family of tokenizers cuts a text before it merges.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

BEYOND = re.compile("[\U00010000-\U0010FFFF]")


@lru_cache(maxsize=1)
def basic_cut() -> re.Pattern:
    """``PRE_TOKEN`` for texts of the basic plane, with its classes as explicit ranges, which ``re`` takes half the time for."""
    plane = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))

    def ranges(kind: str) -> str:
        parts = [m.group() for half in (plane[:0xD800], plane[0xD800:]) for m in regex.finditer(f"{kind}+", half)]
        return "".join(f"\\u{ord(part[0]):04x}-\\u{ord(part[-1]):04x}" for part in parts)

    letter, number, space = map(ranges, (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(f" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?[^{space}{letter}{number}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+")


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for
    itself, the others counted on from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges and ids of a tokenizers file, checked to be of the kind this module handles."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        plain = (spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel"
                 and not spec["pre_tokenizer"]["add_prefix_space"] and model["type"] == "BPE"
                 and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                            for t in spec["added_tokens"]):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        letters = byte_letters()
        self.ids: dict[bytes, int] = {bytes(map(letters.__getitem__, t)): i for t, i in model["vocab"].items()}
        self.bytes = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        known = {bytes([b]) for b in range(256)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        for rank, (a, b) in enumerate(pairs):
            left, right = (bytes(map(letters.__getitem__, x)) for x in (a, b))
            if left not in known or right not in known:
                raise ValueError("a merge uses a token that no earlier merge makes")
            known.add(left + right)
            self.merges.setdefault((self.ids[left], self.ids[right]), (rank, self.ids[left + right]))
        self.ranks = {pair: rank for pair, (rank, _) in self.merges.items()}
        self.made = [0] * len(pairs)
        for rank, token in self.merges.values():
            self.made[rank] = token
        single, never = self.single, len(self.made)
        self.first = [[self.ranks.get((a, b), never) for b in single] for a in single]  # ranks of pairs of bytes
        self.lookahead = lookahead([(left, right, made, len(self.bytes[left]))
                                    for (left, right), (_, made) in sorted(self.merges.items(), key=lambda m: m[1])])

    def merge(self, data: bytes) -> list[int]:
        """Tokens of a whole pre-token."""
        return self._short(data) if len(data) <= CACHED_BYTES else self._long(data)

    def _short(self, data: bytes) -> list[int]:
        """Merge the pair of lowest rank, the first of equals, until no pair has one."""
        single, first, rank_of, made, never = self.single, self.first, self.ranks.get, self.made, len(self.made)
        ids = [single[b] for b in data]
        ranks = [first[a][b] for a, b in zip(data, data[1:])]
        left = len(ranks)
        while left and (low := min(ranks)) < never:
            i = ranks.index(low)
            token = ids[i] = made[low]
            del ranks[i], ids[i + 1]
            left -= 1
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], token), never)
            if i < left:
                ranks[i] = rank_of((token, ids[i + 1]), never)
        return ids

    def _long(self, data: bytes) -> list[int]:
        """The same with a heap of pairs over a linked list."""
        ids: list[int | None] = [self.single[b] for b in data]
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(merges[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = merges[a, b][1], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (p := (ids[i], ids[after[i]])) in merges:
                    heapq.heappush(heap, (merges[p][0], i, *p))
            if (k := before[i]) >= 0 and (p := (ids[k], ids[i])) in merges:
                heapq.heappush(heap, (merges[p][0], k, *p))
        return [i for i in ids if i is not None]


def lookahead(merges: list[tuple[int, int, int, int]]) -> int:
    """Bytes after which a token can no longer change, for merges (left, right, made, size of left) in order.

    Let two texts share a start. As the merges are applied in order, the tokens that both share end
    at the end of that start, until the last shared token is the left part of a merge that happens in
    one text alone; then they end before it. The right part of that merge begins where the shared
    tokens ended, so it has grown out of what stood there after the last such merge: that merge's
    left part or the token it made. The longest chain of such left parts is the bound.
    """
    lefts: dict[int, list[int]] = {}
    reach: dict[int, int] = {}
    most = 0
    for left, right, made, size in merges:
        open_, seen, best = [right], {right}, 0
        while open_:
            token = open_.pop()
            best = max(best, reach.get(token, 0))
            new = [x for x in lefts.get(token, ()) if x not in seen]
            seen.update(new)
            open_ += new
        total = size + best
        for token in (left, made):
            reach[token] = max(reach.get(token, 0), total)
        lefts.setdefault(made, []).append(left)
        most = max(most, total)
    return most


class Transducer:
    """Takes one pre-token in parts and gives its ids as they settle."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.held = vocabulary, b""

    def feed(self, part: bytes) -> Iterator[int]:
        self.held += part
        vocabulary = self.vocabulary
        while len(self.held) > vocabulary.lookahead + STEP:
            head = self.held[:vocabulary.lookahead + STEP]
            done = 0
            for token in vocabulary.merge(head):
                end = done + len(vocabulary.bytes[token])
                if end > STEP:
                    break
                yield token
                done = end
            self.held = self.held[done:]

    def finish(self) -> list[int]:
        rest, self.held = self.held, b""
        return self.vocabulary.merge(rest) if rest else []


class Encoder:
    """Text to packed little-endian unsigned 32-bit ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.cut, self.basic = regex.compile(PRE_TOKEN), basic_cut()
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") \
            if vocabulary.special else None
        self.cache = _Cache(self._piece)

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token, through the transducer in parts of ``STEP`` bytes at most."""
        if len(piece) <= CACHED_BYTES:
            ids = self.vocabulary.merge(piece.encode())
            return struct.pack(f"<{len(ids)}I", *ids)
        machine, out = Transducer(self.vocabulary), []
        for i in range(0, len(piece), STEP // 4):
            out.append(np.fromiter(machine.feed(piece[i:i + STEP // 4].encode()), "<u4").tobytes())
        out.append(np.array(machine.finish(), "<u4").tobytes())
        return b"".join(out)

    def _plain(self, text: str) -> Iterator[bytes]:
        at, size = 0, len(text)
        while at < size:
            window = text[at:at + WINDOW]
            found = (self.cut if BEYOND.search(window) else self.basic).findall(window)
            if at + WINDOW < size:
                held = len(found.pop())  # what follows may lengthen the last piece
                while found and held + len(found[-1]) < AHEAD:  # or join a "'" and a letter
                    held += len(found.pop())
                if not found:  # a pre-token longer than the window
                    end = self.cut.match(text, at).end()
                    yield self._piece(text[at:end])
                    at = end
                    continue
                at += len(window) - held
            else:
                at = size
            yield b"".join(map(self.cache.__getitem__, found))

    def encode(self, text: str) -> bytes:
        if self.special is None or not any(s in text for s in self.vocabulary.special):
            return b"".join(self._plain(text))
        parts = self.special.split(text)
        return b"".join(chain.from_iterable(
            [np.array([self.vocabulary.special[p]], "<u4").tobytes()] if i % 2 else self._plain(p)
            for i, p in enumerate(parts)))


class _Cache(dict):
    """Results by pre-token, blind to long ones. When this half is full, it replaces the other: what came in neither leaves."""

    def __init__(self, make):
        super().__init__()
        self.make, self.other = make, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.other.get(piece)
        if found is None:
            found = self.make(piece)
        if len(piece) <= CACHED_BYTES:
            if len(self) >= CACHED // 2:
                self.other = self.copy()
                self.clear()
            self[piece] = found
        return found


class Decoder:
    """Ids to text; an incomplete character waits for its next bytes, a wrong one becomes U+FFFD."""

    def __init__(self, vocabulary: Vocabulary):
        self.table = [vocabulary.bytes.get(i, b"") for i in range(max(vocabulary.bytes) + 1)]
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.machine.decode(b"".join(map(self.table.__getitem__, ids)))

    def finish(self) -> str:
        rest = self.machine.decode(b"", final=True)
        self.machine.reset()
        return rest


@lru_cache(maxsize=4)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def encoder_of(path: str) -> Encoder:
    return Encoder(vocabulary_of(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``ids`` (array<int>).

    ``path`` is a tokenizers file that every executor has. A special token's own text becomes that
    token, as in that library. A null or empty text has an empty array.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            first, packed, total = 0, [], 0
            for i, text in enumerate(batch.column(1)):
                packed.append(encoder.encode(text.as_py() or ""))
                total += len(packed[-1]) // 4
                if total >= BATCH_IDS or i == batch.num_rows - 1:
                    yield _lists(batch.column(0).slice(first, len(packed)), packed)
                    first, packed, total = i + 1, [], 0
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(returning(run), f"doc_id {kind}, ids array<int>"))


def _lists(ids: pa.Array, packed: list[bytes]) -> pa.RecordBatch:
    ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(packed), "<i4"))
    return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(ends), values)],
                                      names=["doc_id", "ids"])


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """Replace the ids by their text in ``out_col``; all other columns stay.

    An input column named ``out_col`` is replaced. Null ids decode to the empty text, an id outside
    the vocabulary fails the job, and a null among the ids too.
    """
    others = [c for c in encoded.columns if c not in (ids_col, out_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary_of(path))
        for batch in batches:
            lists = batch.column(len(others))
            first, texts, total = 0, [], 0
            for i, one in enumerate(lists):
                parts = []
                if one.is_valid:
                    ids = one.values
                    for a in range(0, len(ids), WINDOW):
                        parts.append(decoder.feed(ids.slice(a, WINDOW).to_pylist()
                                                  if ids.null_count else ids.slice(a, WINDOW).to_numpy().tolist()))
                parts.append(decoder.finish())
                texts.append("".join(parts))
                total += len(texts[-1])
                if total >= BATCH_IDS or i == batch.num_rows - 1:
                    kept = batch.slice(first, len(texts))
                    yield pa.RecordBatch.from_arrays([*kept.columns[:-1], pa.array(texts, pa.string())],
                                                     names=[*others, out_col])
                    first, texts, total = i + 1, [], 0
    fields = [f for f in encoded.schema.fields if f.name in others]
    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{out_col}` string"])
    return encoded.select(*others, ids_col).mapInArrow(returning(run), shape)
