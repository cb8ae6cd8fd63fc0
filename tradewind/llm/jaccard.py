"""N-gram Jaccard join over count vectors, exact, with classes and components of near duplicates.

A document is the set of its distinct word shingles, as 64-bit hashes. Hashed into groups, a set is
a point of group counts, and the sum over the groups of the smaller count bounds the overlap of two
sets from above. The bound is used at two resolutions.

* Fine groups (a hash each) route: a set goes under its leading groups, as many as it must share
  one of with every set it can link with. Frequent groups come last in that order, so what very
  many documents share leads only the documents that hold little else.
* Coarse groups (``GROUPS`` counts) search: the points that meet under a leading group are packed
  into a tree whose boxes hold the largest count of each group; pairs of boxes, and then of points,
  are given up once the bound falls below the overlap they need. Pairs of long texts, for which so
  few groups say little, are then bounded by ``FINE_GROUPS`` counts.

Surviving pairs are verified on their whole texts. First each cell's members are compared to a few
of them alone; after that only pairs that are not yet connected are searched for. All that is an
estimate (the frequency sketch, the filter over ids) changes the work and never the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.components import components
from tradewind.llm.words import blocks, mix, returning, shingle_set, split_words
from tradewind.session import scratch

SHINGLE = 5
PERCENT = 75
GROUPS = 256
SKETCH_BITS = 22        # counters of the frequency sketch
SKETCH_PART = 1 << 16   # counters that are added up in one row
TILE = 2048             # expected members of a cell that one group handles with one other tile
FINE_GROUPS = 4096
FINE_FROM = 512         # shingles from which a document has fine counts too
FIRSTS = 4              # smallest cells of a member that are known wherever it is searched for
HUBS = 8                # members that all others are compared to first, in cells over LEAF members
LEAF = 32               # points or boxes in a box of the tree
MOST_PAIRS = 1 << 14    # pairs whose bounds are computed at once
FILTER_BITS = (16, 27)  # size of the filter over candidate ids, as powers of two
SEEN = 1 << 16          # sets a task remembers, to route each once


def needed(a, b):
    """Overlap that sets of these sizes must have to link."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def leading(n: int) -> int:
    """How many of the first elements of a set hold one that any linked set has among its own first."""
    return n - -(-PERCENT * n // 100) + 1


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted shingle hashes) of each text; the text is the second column."""
    for block in blocks(batch.column(1)):
        words = split_words(block, lower=True)
        for i in range(block.n):
            yield block.first + i, shingle_set(words.hashes[words.of_text[i]:words.of_text[i + 1]], SHINGLE)


def node_of(found: np.ndarray) -> int:
    """The identity of a set: equal sets have equal ones."""
    with np.errstate(over="ignore"):
        total = found.sum(dtype=np.uint64) ^ mix(found).sum(dtype=np.uint64)
    return int(mix(np.array([total, len(found)], np.uint64)).view(np.int64)[0])


def point_of(found: np.ndarray) -> bytes:
    """Counts by coarse group, 255 at most, and behind them what is over 255 in all."""
    counts = np.bincount((found & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
    low = np.minimum(counts, 255)
    return low.astype(np.uint8).tobytes() + int((counts - low).sum()).to_bytes(8, "little")


def fine_of(found: np.ndarray) -> bytes | None:
    """Counts by fine group, packed; none for short texts, or if a count is over 255."""
    if len(found) < FINE_FROM:
        return None
    counts = np.bincount((found & np.uint64(FINE_GROUPS - 1)).astype(np.int64), minlength=FINE_GROUPS)
    return zstandard.compress(counts.astype(np.uint8).tobytes(), 1) if counts.max() <= 255 else None


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summed coordinate minima of rows of points (as bytes) with the minimum of what is over 255."""
    low = np.minimum(a[:, :GROUPS], b[:, :GROUPS]).sum(1, dtype=np.int64)
    over = [np.ascontiguousarray(x[:, GROUPS:]).view("<i8")[:, 0] for x in (a, b)]
    return low + np.minimum(*over)


def _counter(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and at the end of the task its part of the frequency sketch."""
    sketch, total = np.zeros(1 << SKETCH_BITS, np.uint32), 0
    names = ["doc_id", "n", "node", "point", "fine", "part", "counts"]
    for batch in batches:
        ns, nodes, points, fines = [], [], [], []
        for _, found in _sets(batch):
            ns.append(len(found))
            nodes.append(node_of(found) if len(found) else None)
            points.append(point_of(found) if len(found) else None)
            fines.append(fine_of(found))
            np.add.at(sketch, _counter(found), np.uint32(1))
            total += len(found)
        none = pa.nulls(len(ns))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ns, pa.int64()), pa.array(nodes, pa.int64()), pa.array(points, pa.binary()),
             pa.array(fines, pa.binary()), none.cast(pa.int32()), none.cast(pa.binary())], names=names)
    if total:
        kind = batch.schema.field(0).type
        parts = sketch.reshape(-1, SKETCH_PART)
        held = [i for i in range(len(parts)) if parts[i].any()]
        none = pa.nulls(len(held))
        pack = zstandard.ZstdCompressor(level=1).compress
        yield pa.RecordBatch.from_arrays(
            [none.cast(kind), none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.binary()),
             none.cast(pa.binary()), pa.array(held, pa.int32()), pa.array([pack(parts[i].tobytes()) for i in held], pa.binary())], names=names)


def _add_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the counters, part by part; the parts come sorted."""
    unpack = zstandard.ZstdDecompressor().decompress
    at, total = None, None

    def done() -> pa.RecordBatch:
        packed = zstandard.ZstdCompressor(level=1).compress(np.minimum(total, 2**32 - 1).astype("<u4").tobytes())
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([packed], pa.binary())],
                                          names=["part", "counts"])

    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if part != at:
                if at is not None:
                    yield done()
                at, total = part, np.zeros(SKETCH_PART, np.uint64)
            total += np.frombuffer(unpack(counts), "<u4")
    if at is not None:
        yield done()


def levels_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each counter its level (0: as frequent as chance explains) and the tiles its cells need."""
    usual = counts.mean()
    noise = 6 * np.sqrt(usual) + 16
    excess = np.maximum(counts - usual, 0)
    level = np.where(excess < noise, 0, 1 + np.floor(np.log2(np.maximum(excess / noise, 1)))).astype(np.uint8)
    return level, np.where(level > 0, np.ceil(excess / TILE), 1).clip(1).astype(np.uint32)


def _route(packed: tuple[bytes, bytes]) -> Callable:
    """Rows (cell, node, n) for the leading groups of every set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        level, tiles = np.frombuffer(unpack(packed[0]), np.uint8), np.frombuffer(unpack(packed[1]), "<u4")
        seen: set[int] = set()
        for batch in batches:
            cells, nodes, sizes, total = [], [], [], 0
            for _, found in _sets(batch):
                if not len(found) or (node := node_of(found)) in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(node)
                at = _counter(found)
                first = np.argsort(level[at], kind="stable")[:leading(len(found))]
                keys, parts = found[first], tiles[at[first]]
                wide = parts > 1
                out = [mix(keys[~wide])]
                for key, part in zip(keys[wide], parts[wide].tolist()):
                    out.append(_tiled(key, int(np.uint64(node % 2**64) % np.uint64(part)), part))
                cell = np.concatenate(out)
                cells.append(cell)
                nodes.append(node)
                sizes.append(len(found))
                total += len(cell)
                if total >= 1 << 18:
                    yield _cells(cells, nodes, sizes)
                    cells, nodes, sizes, total = [], [], [], 0
            if cells:
                yield _cells(cells, nodes, sizes)
    return run


def _tiled(key: np.uint64, own: int, parts: int) -> np.ndarray:
    """The groups of a frequent cell for a member of tile ``own``: one for each other tile and its own."""
    other = np.arange(parts, dtype=np.uint64)
    low, high = np.minimum(other, np.uint64(own)), np.maximum(other, np.uint64(own))
    return mix(mix(mix(np.array([key], np.uint64)) + low + np.uint64(1)) ^ (high + np.uint64(1)))


def _cells(cells: list[np.ndarray], nodes: list[int], sizes: list[int]) -> pa.RecordBatch:
    each = [len(c) for c in cells]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(cells).view(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), each)),
         pa.array(np.repeat(np.array(sizes, np.int32), each))], names=["cell", "node", "n"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The same rows, cut where the first column changes, so that no run of it is divided."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        last = int(np.searchsorted(key, key[-1], side="left"))
        if last == 0 and held and held[-1].column(0)[held[-1].num_rows - 1].as_py() == key[0]:
            held.append(batch)
            continue
        whole = [*held, *([batch.slice(0, last)] if last else [])]
        if whole:
            yield pa.Table.from_batches(whole)
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, hub, node, n) of the members that have another one of fitting size; sorted by cell, n, node.

    Rows without a cell only tell further hubs of a large cell.
    """
    for rows in _runs(batches):
        cell, node, n = (rows.column(i).to_numpy() for i in range(3))
        new = np.ones(len(cell), bool)
        new[1:] = (cell[1:] != cell[:-1]) | (node[1:] != node[:-1])
        cell, node, n = cell[new], node[new], n[new].astype(np.int64)
        fits = (cell[1:] == cell[:-1]) & (100 * n[:-1] >= PERCENT * n[1:])
        keep = np.zeros(len(cell), bool)
        keep[1:] |= fits
        keep[:-1] |= fits
        cell, node, n = cell[keep], node[keep], n[keep]
        if len(cell):
            # one hub for each stretch of sizes in which neighbours fit
            head = np.ones(len(cell), bool)
            head[1:] = (cell[1:] != cell[:-1]) | (100 * n[:-1] < PERCENT * n[1:])
            hub = np.minimum.reduceat(node, np.flatnonzero(head))[np.cumsum(head) - 1]
            names = ["cell", "hub", "node", "n"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell), pa.array(hub), pa.array(node), pa.array(n.astype(np.int32))], names=names)
            edges = np.append(np.flatnonzero(head), len(cell))
            for a, b in zip(edges[:-1], edges[1:]):
                if b - a > LEAF:
                    own = node[a:b]
                    for k in range(1, HUBS):
                        other = own[np.argmin(mix(own.view(np.uint64) + np.uint64(k)))]
                        yield pa.RecordBatch.from_arrays(
                            [pa.nulls(b - a, pa.int64()), pa.array(np.full(b - a, other)), pa.array(own),
                             pa.array(n[a:b].astype(np.int32))], names=names)


def tree_join(points: np.ndarray, n: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs whose bound allows a link and whose groups differ, by a tree over the points.

    Points come in order of size. Each level packs ``LEAF`` neighbours into a box with the largest
    count of each group and the range of sizes; a box of one connected group is not joined to itself.
    """
    levels = [(points, n, n, group)]
    while len(levels[-1][0]) > LEAF:
        box, low, high, of = levels[-1]
        at = np.arange(0, len(box), LEAF)
        same = np.minimum.reduceat(of, at) == np.maximum.reduceat(of, at)
        upper = np.concatenate([np.maximum.reduceat(box[:, :GROUPS], at), np.ascontiguousarray(
            np.maximum.reduceat(np.ascontiguousarray(box[:, GROUPS:]).view("<i8")[:, 0], at)[:, None]).view(np.uint8)
            .reshape(len(at), 8)], axis=1)
        levels.append((upper, np.minimum.reduceat(low, at), np.maximum.reduceat(high, at),
                       np.where(same, np.minimum.reduceat(of, at), np.int64(-1))))
    top = np.arange(len(levels[-1][0]))
    pending = [(len(levels) - 1, *np.array([(i, j) for i in top for j in top[i:]], np.int64).reshape(-1, 2).T)]
    while pending:
        level, i, j = pending.pop()
        if len(i) > (MOST_PAIRS // LEAF if level else MOST_PAIRS):
            half = len(i) // 2
            pending += [(level, i[:half], j[:half]), (level, i[half:], j[half:])]
            continue
        box, low, high, of = levels[level]
        ok = (100 * high[i] >= PERCENT * low[j]) & ((of[i] < 0) | (of[i] != of[j]))
        if level == 0:
            ok &= i != j
        i, j = i[ok], j[ok]
        ok = overlap_bound(box[i], box[j]) >= needed(low[i], low[j])
        i, j = i[ok], j[ok]
        if level == 0:
            if len(i):
                yield i, j
            continue
        size = len(levels[level - 1][0])
        step = np.arange(LEAF)
        a = (i[:, None, None] * LEAF + step[None, :, None] + np.zeros((1, 1, LEAF), np.int64)).ravel()
        b = (j[:, None, None] * LEAF + step[None, None, :] + np.zeros((1, LEAF, 1), np.int64)).ravel()
        ok = (a < size) & (b < size) & (a <= b)
        pending.append((level - 1, a[ok], b[ok]))


def _all_pairs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (earlier, later) inside each of some runs."""
    first = np.repeat(starts, sizes)
    before = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    later = np.repeat(first + before, before)
    earlier = np.arange(len(later)) - np.repeat(np.cumsum(before) - before, before) + np.repeat(first, before)
    return earlier, later


def _met_before(firsts: np.ndarray, i: np.ndarray, j: np.ndarray, cell: np.ndarray) -> np.ndarray:
    """Whether both of a pair are known to meet under a smaller cell too, where the pair is found anyway."""
    a, b = firsts[i][:, :, None], firsts[j][:, None, :]
    return ((a == b) & (a < cell[:, None, None])).any((1, 2))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) ids of candidate pairs; rows (cell, n, id, group, point, firsts) sorted by cell and n."""
    for rows in _runs(batches):
        lists = rows.column(5).combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        firsts = np.full((len(lists), FIRSTS), np.iinfo(np.int64).max)
        at = np.repeat(np.arange(len(lists)), lengths)
        firsts[at, np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = lists.flatten().to_numpy()
        cell, n, ids, group = (rows.column(i).to_numpy() for i in range(4))
        raw = rows.column(4).combine_chunks()
        points = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(len(n), GROUPS + 8)
        n = n.astype(np.int64)
        edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
        found = set()
        size = np.diff(edges)
        for a, b in zip(edges[:-1][size > LEAF], edges[1:][size > LEAF]):
            for i, j in tree_join(points[a:b], n[a:b], group[a:b]):
                new = ~_met_before(firsts, a + i, a + j, cell[a + i])
                found.update(zip(ids[a + i[new]].tolist(), ids[a + j[new]].tolist()))
        small = np.flatnonzero((size > 1) & (size <= LEAF))
        for k in range(0, len(small), 256):
            part = small[k:k + 256]
            i, j = _all_pairs(edges[part], size[part])
            ok = (group[i] != group[j]) & (100 * n[i] >= PERCENT * n[j])
            i, j = i[ok], j[ok]
            for s in range(0, len(i), MOST_PAIRS):
                x, y = i[s:s + MOST_PAIRS], j[s:s + MOST_PAIRS]
                ok = overlap_bound(points[x], points[y]) >= needed(n[x], n[y])
                x, y = x[ok], y[ok]
                new = ~_met_before(firsts, x, y, cell[x])
                found.update(zip(ids[x[new]].tolist(), ids[y[new]].tolist()))
        pairs = sorted({(min(p), max(p)) for p in found})
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs]), pa.array([p[1] for p in pairs])],
                                             names=["a", "b"])


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, n_a, n_b, point_a, point_b) whose bound allows a link."""
    for batch in batches:
        n = [batch.column(i).to_numpy().astype(np.int64) for i in (2, 3)]
        points = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, GROUPS + 8) for i in (4, 5)]
        ok = overlap_bound(*points) >= needed(*n)
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(ok)) for i in (0, 1)], names=["a", "b"])


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, n_a, n_b, fine_a, fine_b) that the fine counts allow to link; without counts all may."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        ok = []
        for n_a, n_b, a, b in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
            ok.append(a is None or b is None or int(np.minimum(
                np.frombuffer(unpack(a), np.uint8), np.frombuffer(unpack(b), np.uint8)).sum(dtype=np.int64))
                >= needed(n_a, n_b))
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], names=["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, text_a, text_b) that link, on the whole sets."""
    for batch in batches:
        ok = []
        sets = [[found for _, found in _sets(pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(i)], names=["id", "text"]))] for i in (2, 3)]
        for a, b in zip(*sets):
            common = len(np.intersect1d(a, b, assume_unique=True))
            ok.append(common > 0 and 100 * common >= PERCENT * (len(a) + len(b) - common))
        keep = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], names=["a", "b"])


class Join:
    """The join of one corpus; intermediate tables are written below one folder of the shared scratch."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        self.spark = docs.sparkSession
        self.docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        self.kind = docs.schema[id_col].dataType.simpleString()
        self.folder = scratch(self.spark, f"jaccard-{uuid.uuid4().hex[:8]}")

    def _store(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{name}")

    def run(self) -> DataFrame:
        described = self._store(self.docs.mapInArrow(
            returning(_describe), f"doc_id {self.kind}, n long, node long, point binary, fine binary, part int, counts binary"), "described")
        rows = described.where(F.col("part").isNull()).select("doc_id", "n", "node", "point", "fine")
        # copies are one node, named by its smallest id; ids may be null only where all of a class are
        nodes = self._store(rows.where(F.col("node").isNotNull()).groupBy("node").agg(
            F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("point").alias("point"),
            F.first("fine").alias("fine"))
            .where(F.col("id").isNotNull()), "nodes")
        members = self._members(self._levels(described))
        cells = members.where("cell is not null").select("cell", "node", "n")
        star = members.where("node <> hub").select(F.col("hub").alias("x"), F.col("node").alias("y")).distinct()
        first = self._store(self._linked(self._close(star, nodes), nodes, "star"), "links-1")
        known = self._store(components(first), "components-1")
        second = self._store(self._linked(self._candidates(cells, nodes, known), nodes, "tree"), "links-2")
        reach = components(first.unionByName(second))
        ids = (nodes.select("node", "id").join(reach.withColumnRenamed("component", "reached"), "id", "left")
               .select("node", F.coalesce("reached", "id").alias("reached")))
        return (rows.select("doc_id", "n", "node").join(ids, "node", "left")
                .select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("doc_id").isNotNull(), F.coalesce("reached", "doc_id")).alias("component_id")))

    def _levels(self, described: DataFrame) -> tuple[bytes, bytes]:
        """The frequency sketch of the corpus: fixed in size, summed by part in Spark."""
        parts = (described.where(F.col("part").isNotNull()).select("part", "counts")
                 .repartition("part").sortWithinPartitions("part").mapInArrow(returning(_add_parts), "part int, counts binary"))
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        unpack = zstandard.ZstdDecompressor().decompress
        for row in parts.collect():  # 2**SKETCH_BITS / SKETCH_PART rows
            counts[row["part"] * SKETCH_PART:(row["part"] + 1) * SKETCH_PART] = np.frombuffer(unpack(row["counts"]), "<u4")
        pack = zstandard.ZstdCompressor(level=3).compress
        level, tiles = levels_of(counts)
        return pack(level.tobytes()), pack(tiles.astype("<u4").tobytes())

    def _members(self, packed: tuple[bytes, bytes]) -> DataFrame:
        routed = self.docs.select("doc_id", "text").mapInArrow(returning(_route(packed)), "cell long, node long, n int")
        return self._store(routed.repartition("cell").sortWithinPartitions("cell", "n", "node")
                           .mapInArrow(returning(_members), "cell long, hub long, node long, n int"), "cells")

    def _close(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Pairs of nodes as pairs of ids, without those that the bound rules out."""
        side = lambda c: nodes.select(F.col("node").alias(c), F.col("id").alias(f"id_{c}"),
                                      F.col("n").alias(f"n_{c}"), F.col("point").alias(f"point_{c}"))
        both = pairs.join(side("x"), "x").join(side("y"), "y")
        fits = (100 * F.col("n_x") >= PERCENT * F.col("n_y")) & (100 * F.col("n_y") >= PERCENT * F.col("n_x"))
        return (both.where(fits).select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b"),
                                        "n_x", "n_y", "point_x", "point_y")
                .mapInArrow(returning(_bounded), f"a {self.kind}, b {self.kind}"))

    def _candidates(self, cells: DataFrame, nodes: DataFrame, known: DataFrame) -> DataFrame:
        """Pairs that the tree finds among members of a cell that are not connected yet."""
        known = known.select("id", F.xxhash64("component").alias("grouped"))
        nodes = nodes.join(known, "id", "left").select(
            "node", "id", F.coalesce("grouped", F.xxhash64("id")).bitwiseAND(F.lit(2**63 - 1)).alias("group"), "point")
        # the few cells whose members are all connected need no search
        tagged = cells.join(nodes.select("node", "group"), "node").select("cell", "node", "group")
        open_ = tagged.groupBy("cell").agg(F.min("group").alias("low"), F.max("group").alias("high")) \
            .where("low <> high").select("cell")
        cells = self._store(cells.join(open_, "cell", "left_semi"), "open")
        firsts = cells.groupBy("node").agg(  # at most as many cells as a text has leading groups
            F.slice(F.array_sort(F.collect_set("cell")), 1, FIRSTS).alias("firsts"))
        return (cells.join(nodes, "node").join(firsts, "node")
                .select("cell", "n", "id", "group", "point", "firsts")
                .repartition("cell").sortWithinPartitions("cell", "n")
                .mapInArrow(returning(_search), f"a {self.kind}, b {self.kind}").distinct())

    def _linked(self, pairs: DataFrame, nodes: DataFrame, name: str) -> DataFrame:
        """The pairs that link. Only texts of documents in some pair are moved."""
        fine = nodes.where(F.col("fine").isNotNull())
        side = lambda c: fine.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"),
                                     F.col("fine").alias(f"fine_{c}"))
        pairs = (pairs.where("a <> b").join(side("a"), "a", "left").join(side("b"), "b", "left")
                 .select("a", "b", "n_a", "n_b", "fine_a", "fine_b")
                 .mapInArrow(returning(_finer), f"a {self.kind}, b {self.kind}"))
        pairs = self._store(pairs.distinct(), f"pairs-{name}")
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        texts = self._store(self._texts(ids), f"texts-{name}")
        return (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
                .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
                .select("a", "b", "text_a", "text_b").mapInArrow(returning(_verify), f"a {self.kind}, b {self.kind}").distinct())

    def _texts(self, ids: DataFrame) -> DataFrame:
        """Texts of some ids: a filter of fixed size drops most other rows before the shuffle."""
        count = ids.count()
        bits = 1 << min(max((16 * count).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
        place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
        # the bitmap functions count from 1
        rows = (ids.select((place + 1).alias("p"))
                .select(F.bitmap_bucket_number("p").alias("bucket"), F.bitmap_bit_position("p").alias("bit"))
                .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())  # bits / 8 bytes
        flags = np.zeros(bits + 32768, bool)
        for row in rows:
            held = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little")
            start = (row["bucket"] - 1) * 32768
            flags[start:start + len(held)] = held
        packed = zstandard.ZstdCompressor().compress(np.packbits(flags).tobytes())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
            for batch in batches:
                p = batch.column(2).to_numpy()
                held = known[p >> 3] >> (7 - (p & 7)).astype(np.uint8) & 1
                yield batch.filter(pa.array(held.astype(bool))).select(["doc_id", "text"])

        maybe = self.docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", place.alias("p")) \
            .mapInArrow(returning(run), f"doc_id {self.kind}, text string")
        return maybe.join(ids, "doc_id", "left_semi").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles`` and ``component_id``.

    Two documents link when 100 * intersection >= 75 * union of their shingle sets; a component's id
    is the smallest document id that can be reached. A text with fewer than five words is one shingle
    of them all. Null, empty and blank texts have no shingles and stay alone. Copies share a class
    and are compared once. Repeated rows give a row each; an id with several texts connects what each
    of them links with. Rows without an id get their size and a null component. Two different sets
    are taken for one if 64-bit hashes of them agree.
    """
    return Join(docs, id_col, text_col).run()
