"""Repair of conversation structure: the cheapest edits that make a conversation alternate.

A repaired conversation is empty, or an optional ``s...`` row followed by one or more pairs of a
``u...`` and an ``a...`` row. Keeping a row costs 0, giving it the role user or assistant 2, deleting
it 3 (the only choice for a blank or duplicate row), inserting an empty user or assistant row 2; a
truncated row that is not deleted adds 1. Among the cheapest repairs the one whose edits' initials
(D, I, K, R) come first in ASCII order is taken; these letters are the audit.

The edits follow from backward costs: for each row, what the rest of the conversation costs from each
of the four states (nothing yet, after s, after u, after a). Only differences between the four decide,
and there are few such vectors (``VECTORS``), so one step is a table look-up. Rows are sorted once by
range over the whole table. A conversation inside one sorted partition, within ``CHUNK_ROWS`` and
``CHUNK_CHARS``, is repaired as the stream passes. All others are cut into chunks: each chunk starts
from a speculative vector at its right edge, and fix-up passes rerun the chunks whose right neighbour
turned out otherwise, up to the row where old and new vectors differ by a constant only. Rows that only
shift a vector (long runs of blank rows) could pass a difference on for ever; what has not settled after
``passes`` passes is composed from the chunks' maps by doubling. Every chunk is then traced from each
of the four states, and the states at the chunk borders are found by doubling too.

Null roles and texts count as one space. Rows go by turn, null first; rows that share a turn by role,
the first 64 characters of the text, a hash of it. A null conversation id is an id like others. Blank,
duplicate (role and text seen earlier in the conversation), truncated: the first that fits counts. A
role whose first letter is none of s, u, a, or an empty one, can be changed or deleted but not kept.
Repeated rows are duplicates. Further columns are left out; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tradewind.session import scratch

CHUNK_ROWS = 1024
CHUNK_CHARS = 1 << 20
BATCH_CHARS = 1 << 21
PASSES = 4

SPACE = " \t\n\x0b\x0c\r"
ROLES = "sua"                                    # 3 stands for every other role
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)     # a row's code is 4 * fault + role
START, S, U, A = range(4)                        # states
NEXT = (U, U, A, U)                              # where an inserted or changed row leads
KEEP = ({START: S}, {START: U, S: U, A: U}, {U: A}, {})
LEGAL = {(0, 1), (1, 2), (2, 1)}
FINAL_COSTS, SPECULATIVE_COSTS = (0, 4, 2, 0), (0, 0, 0, 0)
ENDING = ("", "II", "I", "")


def _choices(code: int, after: tuple, q: int) -> list[tuple[int, str, int]]:
    """Cost to the end, letter and next state of what can be done with a row in state q."""
    fault, role = divmod(code, 4)
    found = [(3 + after[q], "D", q)]
    if fault < BLANK:
        found.append((2 + fault + after[NEXT[q]], "R", NEXT[q]))
        if q in KEEP[role]:
            found.append((fault + after[KEEP[role][q]], "K", KEEP[role][q]))
    return found


def _before(code: int, after: tuple) -> tuple[int, ...]:
    costs = [min(_choices(code, after, q))[0] for q in range(4)]
    for _ in range(2):  # at most two rows are worth inserting at one place
        costs = [min(costs[q], 2 + costs[NEXT[q]]) for q in range(4)]
    return tuple(costs)


def _moves(code: int, after: tuple) -> list[tuple[str, int, int]]:
    """For each state: the letters up to and with the row's own, the next state, and their cost."""
    costs, found = _before(code, after), []
    for q in range(4):
        letters, at, spent = "", q, 0
        while not letters or letters[-1] == "I":
            here = [(letter, to, cost - after[to]) for cost, letter, to in _choices(code, after, at) if cost == costs[at]]
            if 2 + costs[NEXT[at]] == costs[at]:
                here.append(("I", NEXT[at], 2))
            letter, at, cost = min(here)
            letters, spent = letters + letter, spent + cost
        found.append((letters, at, spent))
    return found


def _tables():
    """All cost vectors less their least entry, the vector before each row code, and the moves."""
    vectors, back, moves = [FINAL_COSTS, SPECULATIVE_COSTS], [], []
    for v in vectors:  # grows while it is read
        rows = [_before(code, v) for code in range(16)]
        rows = [tuple(c - min(r) for c in r) for r in rows]
        vectors.extend(r for r in dict.fromkeys(rows) if r not in vectors)
        back.append([vectors.index(r) for r in rows])
        moves.append([_moves(code, v) for code in range(16)])
    return vectors, back, moves


VECTORS, BACK, MOVES = _tables()
FINAL, SPECULATIVE = 0, 1


def backward(codes: bytes, right: int) -> int:
    """The vector before a chunk, from the one behind it."""
    for code in reversed(codes):
        right = BACK[right][code]
    return right


def fix_up(codes: bytes, old: int, left: int, new: int) -> int:
    """``backward`` from ``new``, given that ``old`` led to ``left``: it stops where both are one vector."""
    for code in reversed(codes):
        if old == new:
            return left
        old, new = BACK[old][code], BACK[new][code]
    return new


def trace(codes: bytes, right: int, q: int) -> tuple[list[str], int, int]:
    """Letters for each row from state ``q``, the state behind the chunk, and the cost."""
    after = []
    for code in reversed(codes):
        after.append(right)
        right = BACK[right][code]
    letters, cost = [], 0
    for code, v in zip(codes, reversed(after)):
        step, q, spent = MOVES[v][code][q]
        letters.append(step)
        cost += spent
    return letters, q, cost


def apply(letters: list[str], lines: list[tuple[str, str]], q: int) -> list[tuple[str, str]]:
    """The repaired rows; ``letters`` may have one entry more, for rows inserted behind the last."""
    out = []
    for k, step in enumerate(letters):
        for letter in step:
            if letter == "D":
                continue
            if letter == "K":
                out.append(lines[k])
                q = KEEP[ROLES.find(lines[k][0][:1])][q]
                continue
            q = NEXT[q]
            out.append(("user" if q == U else "assistant", "" if letter == "I" else lines[k][1]))
    return out


class _Chunk:
    """Rows of one conversation on their way."""

    def __init__(self):
        self.lines, self.codes, self.keys, self.chars = [], bytearray(), {}, 0
        self.turns, self.first, self.last = 0, None, None

    def add(self, turn, role: str, text: str) -> None:
        body, kind = text.rstrip(SPACE), ROLES.find(role[:1]) if role else 3
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        if not body:
            fault = BLANK
        elif key in self.keys:
            fault = DUPLICATE
        else:
            self.keys[key] = len(self.lines)
            fault = FINE if body[-1] in ".!?" else TRUNCATED
        self.codes.append(4 * fault + (kind if kind >= 0 else 3))
        self.lines.append((role, text))
        self.chars += len(text)
        if turn is not None and (self.first is None or turn != self.last):
            self.turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn

    def counts(self) -> dict:
        return counts(bytes(self.codes)) | {"first_turn": self.first, "last_turn": self.last, "n_turns": self.turns}


def counts(codes: bytes) -> dict:
    faults = [c >> 2 for c in codes]
    roles = [c & 3 for c in codes]
    return {"blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
            "illegal": sum(p not in LEGAL for p in zip(roles, roles[1:]))}


def _repaired(codes: bytes, lines: list, q: int, right: int, last: bool) -> dict:
    letters, end, cost = trace(codes, right, q)
    if last:
        letters, cost = [*letters, ENDING[end]], cost + 2 * len(ENDING[end])
    return {"audit": "".join(letters), "cost": cost, "lines": apply(letters, lines, q)}


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(t) for _, t in row.get("lines") or ()) + 100
        if chars > BATCH_CHARS:
            yield _batch(held, schema)
            held, chars = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    named = [dict(zip(("role", "text"), pair)) for r in rows for pair in r.get("lines") or ()]
    columns = []
    for field in schema:
        if field.name == "lines":
            ends = [0]
            for r in rows:
                ends.append(ends[-1] + len(r.get("lines") or ()))
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(named, field.type.value_type)).cast(field.type))
        else:
            columns.append(pa.array([r.get(field.name) for r in rows], field.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


COUNTS = ("blank", "duplicate", "truncated", "illegal")
PIECE = ", ".join([*(f"{c} long" for c in COUNTS), "cost long, first_turn long, last_turn long, n_turns long, audit string",
                   "lines array<struct<role:string,text:string>>"])


def _schema(conv: T.DataType, rest: str) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv), *T._parse_datatype_string(rest).fields])


def _fold(schema: T.StructType, most_rows: int):
    """Sorted rows to repaired conversations, and to chunks of those that may go on elsewhere."""
    arrow = to_arrow_schema(schema)

    def rows(batches) -> Iterator[dict]:
        part, number, conv, chunk, cut, first = TaskContext.get().partitionId(), 0, None, None, True, True

        def chunk_row(whole: bool) -> dict:
            nonlocal number
            number += 1
            row = {"conv_id": conv, "part": part, "number": number, "whole": whole} | chunk.counts()
            codes = bytes(chunk.codes)
            if whole:
                return row | _repaired(codes, chunk.lines, START, FINAL, True)
            return row | {"lines": chunk.lines, "codes": codes,
                          "keys": [{"i": i, "key": key} for key, i in chunk.keys.items()]}

        for batch in batches:
            for at, turn, role, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if chunk is None or at != conv:
                    if chunk is not None:
                        yield chunk_row(not cut)
                        first = False
                    conv, chunk, cut = at, _Chunk(), first
                elif len(chunk.lines) >= most_rows or chunk.chars >= CHUNK_CHARS:
                    yield chunk_row(False)
                    chunk, cut = _Chunk(), True
                chunk.add(turn, role, text)
        if chunk is not None:
            yield chunk_row(False)

    return lambda batches: _batches(rows(batches), arrow)


def _stored(df: DataFrame, label: str) -> DataFrame:
    folder = scratch(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _near(df: DataFrame, columns: dict[str, str], by: int) -> DataFrame:
    """Columns of the chunk ``by`` places further on, to be joined by conversation and place."""
    return df.select(F.col("conv_id").alias("__conv"), (F.col("place") - by).alias("__place"),
                     *[F.col(c).alias(name) for c, name in columns.items()])


def _beside(df: DataFrame, columns: dict[str, str], by: int) -> DataFrame:
    other = _near(df, columns, by)
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("place") == F.col("__place"))
    return df.join(other, same, "left").drop("__conv", "__place")


def compose(df: DataFrame, by: int, most: int) -> DataFrame:
    """``map`` of each chunk, applied behind the maps of all chunks further on (by = 1) or before it (-1)."""
    step = 1
    while step <= most:
        far = _beside(df, {"map": "far"}, by * step)
        near = F.transform("far", lambda x: F.get(F.col("map"), x))
        df = _stored(far.withColumn("map", F.coalesce(near, F.col("map"))).drop("far"), "dialogue-maps")
        step *= 2
    return df


def _settled(chunks: DataFrame, most: int, passes: int) -> DataFrame:
    """Chunks with the vector behind each (``right``)."""
    kept = [c for c in chunks.columns if c in ("conv_id", "place", "last", "codes")]
    schema = T.StructType([*[chunks.schema[c] for c in kept],
                           *T._parse_datatype_string("right int, left int, moved boolean").fields])
    arrow = to_arrow_schema(schema)

    def start(batches):
        for b in batches:
            right = [FINAL if last else SPECULATIVE for last in b.column("last").to_pylist()]
            left = [backward(c, r) for c, r in zip(b.column("codes").to_pylist(), right)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(right, pa.int32()), pa.array(left, pa.int32()),
                                              pa.array([True] * len(left))], schema=arrow)

    def again(batches):
        for b in batches:
            found = [(right, left, False) if want is None or want == right else
                     (want, new := fix_up(codes, right, left, want), new != left)
                     for codes, right, left, want in zip(*(b.column(c).to_pylist() for c in ("codes", "right", "left", "want")))]
            cols = list(zip(*found)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(cols[0], pa.int32()),
                                              pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.bool_())], schema=arrow)

    state = _stored(chunks.select(*kept).mapInArrow(start, schema), "dialogue-costs")
    for _ in range(passes):
        state = _stored(_beside(state, {"left": "want"}, 1).mapInArrow(again, schema), "dialogue-costs")
        if not state.where("moved").limit(1).count():
            return state.drop("left", "moved")

    mapped = T.StructType([*[chunks.schema[c] for c in kept], *T._parse_datatype_string("map array<int>").fields])
    lists = to_arrow_schema(mapped)

    def maps(batches):
        for b in batches:
            every = [[backward(c, FINAL if last else v) for v in range(len(VECTORS))]
                     for c, last in zip(b.column("codes").to_pylist(), b.column("last").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(every, lists.field("map").type)], schema=lists)

    whole = compose(_stored(chunks.select(*kept).mapInArrow(maps, mapped), "dialogue-maps"), 1, most)
    right = F.coalesce(F.get("behind", F.lit(0)), F.lit(FINAL))
    return _beside(whole, {"map": "behind"}, 1).select(*kept, right.alias("right"))


def _ends(settled: DataFrame) -> DataFrame:
    """The state behind each chunk for each of the four before it (``map``)."""
    schema = T.StructType([*settled.schema.fields, *T._parse_datatype_string("map array<int>").fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            every = [[trace(c, r, q)[1] for q in range(4)]
                     for c, r in zip(b.column("codes").to_pylist(), b.column("right").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(every, arrow.field("map").type)], schema=arrow)

    return _stored(settled.mapInArrow(run, schema), "dialogue-ends")


def _placed(chunks: DataFrame) -> DataFrame:
    """Chunks with their place in the conversation (from 0) and whether they are its last.

    Counted by runs: a conversation has one run in each sorted partition it reaches into.
    """
    runs = chunks.groupBy("conv_id", "part").agg(F.min("number").alias("from"), F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("conv_id").orderBy("part")
    before = F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("conv_id").alias("__conv"), F.col("part").alias("__part"), (before - F.col("from")).alias("shift"),
                       F.sum("n").over(Window.partitionBy("conv_id")).alias("total"))
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("part") == F.col("__part"))
    place = F.col("number") + F.col("shift")
    return (chunks.join(runs, same).withColumn("place", place).withColumn("last", place == F.col("total") - 1)
            .drop("__conv", "__part", "shift", "total"))


def _without_duplicates(chunks: DataFrame) -> DataFrame:
    """Codes in which a row that an earlier chunk has too is a duplicate."""
    keys = chunks.select("conv_id", "place", F.explode("keys").alias("k"))
    firsts = (keys.groupBy("conv_id", F.col("k.key").alias("key")).agg(F.min(F.struct("place", "k.i")).alias("first"))
              .groupBy(F.col("conv_id").alias("__conv"), F.col("first.place").alias("__place"))
              .agg(F.collect_list("first.i").alias("fresh")))
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("place") == F.col("__place"))
    kept = ["conv_id", "place", "part", "number", "last", "codes"]
    rows = chunks.select(*kept, F.col("keys.i").alias("seen")).join(firsts, same, "left").select(*kept, "seen", "fresh")
    schema = T.StructType([chunks.schema[c] for c in kept])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            fixed = []
            for codes, seen, fresh in zip(*(b.column(c).to_pylist() for c in ("codes", "seen", "fresh"))):
                codes = bytearray(codes)
                for i in set(seen) - set(fresh or ()):
                    codes[i] = 4 * DUPLICATE + codes[i] % 4
                fixed.append(bytes(codes))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept[:-1]), pa.array(fixed, pa.binary())], schema=arrow)

    return rows.mapInArrow(run, schema)


def _long(chunks: DataFrame, passes: int) -> DataFrame | None:
    """Repaired pieces of the conversations that came as chunks."""
    placed = _stored(_placed(chunks.select("conv_id", "part", "number", "codes", "keys", "last_turn", "first_turn")), "dialogue-places")
    most = placed.agg(F.max("place")).first()[0]
    if most is None:
        return None
    fixed = _stored(_without_duplicates(placed), "dialogue-codes")
    settled = _ends(_settled(fixed, most, passes))
    start = F.coalesce(F.get("before", F.lit(START)), F.lit(START))
    state = (_beside(compose(settled, -1, most), {"map": "before"}, -1)
             .select("conv_id", "place", "right", start.alias("state")))
    edge = _beside(placed.select("conv_id", "place", "part", "number", "first_turn", "last_turn")
                   .join(fixed.select("part", "number", "codes", "last"), ["part", "number"]),
                   {"codes": "codes_before", "last_turn": "turn_before"}, -1)
    known = (edge.join(state.withColumnRenamed("conv_id", "__conv").withColumnRenamed("place", "__place"),
                       F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("place") == F.col("__place")))
             .select("part", "number", "place", "last", "codes", "right", "state",
                     F.expr("right(hex(codes_before), 1)").alias("role_before"),
                     F.coalesce(F.col("turn_before") == F.col("first_turn"), F.lit(False)).alias("same_turn")))
    rows = chunks.drop("codes", "keys").join(known, ["part", "number"])
    schema = _schema(chunks.schema["conv_id"].dataType, "piece long, whole boolean, " + PIECE)
    arrow = to_arrow_schema(schema)

    def run(batches):
        def made():
            for b in batches:
                for r in b.to_pylist():
                    lines, codes = [(x["role"], x["text"]) for x in r["lines"]], r["codes"]
                    found = counts(codes)
                    if r["role_before"] is not None:
                        found["illegal"] += (int(r["role_before"], 16) % 4, codes[0] % 4) not in LEGAL
                    yield ({"conv_id": r["conv_id"], "piece": r["place"], "whole": r["last"] and not r["place"],
                            "first_turn": r["first_turn"], "last_turn": r["last_turn"],
                            "n_turns": r["n_turns"] - r["same_turn"]} | found
                           | _repaired(codes, lines, r["state"], r["right"], r["last"]))
        return _batches(made(), arrow)

    return rows.mapInArrow(run, schema)


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, passes: int = PASSES) -> DataFrame:
    """Repaired conversations from ``conv_id``, ``turn``, ``role`` and ``text``, in one or more pieces each.

    ``piece`` orders the pieces of a conversation from 0, ``whole`` says that there is one only. Of each
    piece: the faults, ``illegal`` (neighbours whose role initials are none of su, ua, au, also with the
    piece before), ``cost``, ``audit``, the repaired ``lines``; turns for ``gaps`` (``n_turns`` counts
    distinct ones, each in the first piece that has it).
    """
    conv = rows.schema["conv_id"].dataType
    text = F.coalesce("text", F.lit(" "))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       text.alias("text"), F.substring(text, 1, 64).alias("head"), F.xxhash64(text).alias("h"))
    # equal rows are interchangeable, so a row number spreads a hot one without changing any result
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "head", "h", "row"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text")
    schema = _schema(conv, "part int, number long, whole boolean, " + PIECE
                     + ", codes binary, keys array<struct<i:int,key:binary>>")
    folded = _stored(dealt.mapInArrow(_fold(schema, chunk_rows), schema), "dialogues")
    names = ["conv_id", "piece", "whole", *[c.split()[0] for c in PIECE.split(", ")]]
    done = folded.where("whole").withColumn("piece", F.lit(0).cast("long")).select(*names)
    rest = _long(folded.where(~F.col("whole")), passes)
    return done if rest is None else done.unionByName(rest.select(*names))


def summary(pieces: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit, and the digest of its ``role:text`` lines.

    A digest over several pieces is one stream by nature: their lines go in order through one task that
    holds a batch of them at a time.
    """
    spoken = F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    gaps = lambda lo, hi, n: F.coalesce(F.col(hi) - F.col(lo) + 1 - F.col(n), F.lit(0).cast("long")).alias("gaps")
    whole = pieces.where("whole").select(
        "conv_id", gaps("first_turn", "last_turn", "n_turns"), *COUNTS, "cost", "audit",
        F.sha2(F.array_join(spoken, "\n"), 256).alias("repaired_sha256"))
    parts = pieces.where(~F.col("whole"))
    schema = _schema(pieces.schema["conv_id"].dataType, "audit string, repaired_sha256 string")
    arrow = to_arrow_schema(schema)

    def stream(batches):
        conv, digest, begun, letters = None, None, False, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                (conv, "".join(letters), digest.hexdigest()), arrow)], schema=arrow)

        for b in batches:
            for at, audit, said, filled in zip(*(b.column(k).to_pylist() for k in range(4))):
                if digest is None or at != conv:
                    if digest is not None:
                        yield out()
                    conv, digest, begun, letters = at, hashlib.sha256(), False, []
                if filled:
                    digest.update((b"\n" if begun else b"") + said.encode())
                    begun = True
                letters.append(audit)
        if digest is not None:
            yield out()

    digests = (parts.select("conv_id", "piece", "audit", F.array_join(spoken, "\n").alias("said"), (F.size("lines") > 0).alias("filled"))
               .repartition("conv_id").sortWithinPartitions("conv_id", "piece")
               .select("conv_id", "audit", "said", "filled").mapInArrow(stream, schema))
    sums = parts.groupBy(F.col("conv_id").alias("__conv")).agg(
        *[F.sum(c).alias(c) for c in (*COUNTS, "cost", "n_turns")],
        F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"))
    joined = digests.join(sums, F.col("conv_id").eqNullSafe(F.col("__conv"))).select(
        "conv_id", gaps("first_turn", "last_turn", "n_turns"), *COUNTS, "cost", "audit", "repaired_sha256")
    return whole.unionByName(joined)
