"""Words and shingles of whole Arrow batches, as 64-bit hashes in numpy arrays.

A batch is cut into blocks of whole texts of about ``BLOCK_BYTES``; a longer text is a block of
its own. Memory is therefore about 50 bytes for each byte of the block or of the longest text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 18
MIX = np.uint64(0x9E3779B97F4A7C15)

_SEEDED = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _SEEDED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_SEEDED.integers(1, 2**62)) * 2 + 1
_PLACE = _SEEDED.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

# Bytes that end a word: white space, or everything in ASCII but digits and letters.
WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base, modulo 2**64, kept and doubled as longer words come."""
    global _POWERS
    while len(_POWERS) < n:
        step = np.uint64(pow(_BASE, len(_POWERS), 2**64))
        _POWERS = np.concatenate([_POWERS, _POWERS * step])
    return _POWERS


def returning(run: Callable) -> Callable:
    """The task function, which hands free memory back when a task ends: Python workers live on, for other stages."""
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)
    return task


@dataclass
class Block:
    """Some texts of a batch: rows ``first`` to ``last``, their bytes, and where each begins."""
    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return self.last - self.first

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string array into blocks; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    _, where, data = texts.buffers()
    rows = len(texts)
    if not rows:
        return
    ends = np.frombuffer(where, np.int64 if wide else np.int32)[texts.offset:texts.offset + rows + 1]
    ends = ends.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(ends, ends[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield Block(first, last, raw[ends[first]:ends[last]], ends[first:last + 1] - ends[first])
        first = last


@dataclass
class Words:
    """Words of a block: byte bounds, hashes, and the first word of each text (one more at the end)."""
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    of_text: np.ndarray


def split_words(block: Block, lower: bool, between: np.ndarray = WHITE_SPACE) -> Words:
    """Runs of bytes other than those ``between`` words; ``lower`` treats A-Z as a-z."""
    data, offsets = block.data, block.offsets
    size = len(data)
    inside = np.zeros(size + 2, bool)
    inside[1:-1] = ~between[data]
    cut = np.zeros(size + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    of_text = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(starts, ends, np.zeros(0, np.uint64), of_text)
    lengths = ends - starts
    table = _BYTE
    if lower:
        table = _BYTE.copy()
        table[65:91] = table[97:123]
    gap = np.zeros(size, np.int32)
    gap[starts[1:]] = (starts[1:] - starts[:-1]).astype(np.int32)
    place = np.ones(size, np.int32)
    place[0] = 0
    place[starts[0]] = 0
    place[starts[1:]] -= gap[starts[1:]]
    place[:starts[0]] = 0
    place = np.cumsum(place, dtype=np.int64)
    np.minimum(place, int(lengths.max()), out=place)
    values = table[data] * _powers(int(lengths.max()) + 1)[place]
    values[~inside[1:-1]] = 0
    return Words(starts, ends, mix(np.add.reduceat(values, starts)), of_text)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` neighbouring words, over text borders too."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for j in range(size):
        total += hashes[j:j + count] * _PLACE[j]
    return mix(total)


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a shorter text is one shingle of all its words."""
    if 0 < len(hashes) < size:
        # the count enters, so that a short text never equals a window of ``size`` words
        total = np.add.reduce(hashes * _PLACE[:len(hashes)], keepdims=True)
        return mix(total + np.uint64(len(hashes) * int(MIX) % 2**64))
    found = np.sort(windows(hashes, size))
    if len(found) > 1:
        found = found[np.concatenate([[True], found[1:] != found[:-1]])]
    return found


def word_starts(block: Block, words: Words, sizes: range, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first bytes of each word longer than that, for each size, and their words' numbers."""
    table = _BYTE
    if lower:
        table = _BYTE.copy()
        table[65:91] = table[97:123]
    numbers = np.flatnonzero(words.ends - words.starts > sizes[0])
    total = np.zeros(len(numbers), np.uint64)
    hashes, of = [], []
    for size in range(1, sizes[-1] + 1):
        if size > sizes[0]:
            longer = words.ends[numbers] - words.starts[numbers] > size
            numbers, total = numbers[longer], total[longer]
        total = total + table[block.data[words.starts[numbers] + size - 1]] * _powers(size)[size - 1]
        if size in sizes:
            hashes.append(mix(total + np.uint64(size * int(MIX) % 2**64)))
            of.append(numbers)
    return np.concatenate(hashes), np.concatenate(of)
