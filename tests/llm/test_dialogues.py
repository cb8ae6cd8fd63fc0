"""Conversation repair against its SQL and a search over all edits."""

import hashlib
import random
from itertools import product

import pytest
from conftest import SF, rows
from oracle import connect, rows_of

from tradewind.llm import dialogues, queries

SPEC = "conv_id long, turn long, role string, text string"


def best(said):
    """Cheapest (cost, audit, lines) by trying every edit of every row, with up to two rows put in before each."""
    seen, found = set(), {(0, ""): (0, "", ())}
    for role, text in said:
        body = text.strip(dialogues.SPACE)
        bad = not body or (role, text) in seen
        seen.add((role, text))
        late = bool(body) and not bad and body[-1] not in ".!?"
        step = {}
        for cost, audit, lines in found.values():
            for more in ((), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")):
                head = (cost + 2 * len(more), audit + "I" * len(more), lines + tuple((r, "") for r in more))
                ways = [(3, "D", ())]
                if not bad:
                    ways += [(late, "K", ((role, text),)), (2 + late, "R", (("user", text),)), (2 + late, "R", (("assistant", text),))]
                for price, letter, line in ways:
                    shape = "".join(r[:1] or "?" for r, _ in head[2] + line)
                    if legal(shape):
                        new = (head[0] + price, head[1] + letter, head[2] + line)
                        key = (shape[-1:], shape == "s")
                        step[key] = min(step.get(key, new), new)
        found = step
    ends = []
    for cost, audit, lines in found.values():
        for more in ((), ("user",), ("assistant",), ("user", "assistant")):
            out = lines + tuple((r, "") for r in more)
            shape = "".join(r[:1] for r, _ in out)
            if not shape or legal(shape) and shape[-1] == "a":
                ends.append((cost + 2 * len(more), audit + "I" * len(more), out))
    return min(ends)


def legal(shape):
    rest = shape[1:] if shape[:1] == "s" else shape
    return all(c == "ua"[i % 2] for i, c in enumerate(rest))


def random_said(rng, n):
    roles, texts = ["user", "assistant", "system", "tool", ""], ["Yes.", "no", " ", "Why?", "", "a\n", "b!\t", "c"]
    return [(rng.choice(roles), rng.choice(texts) + rng.choice(["", str(rng.randrange(30)), "."])) for _ in range(n)]


def expected(conv, said, turns):
    cost, audit, lines = best(said)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return conv, cost, audit, gaps, digest


@pytest.mark.parametrize("chunk_rows,passes", [(1024, 4), (3, 4), (2, 0)])
def test_op11_against_every_edit(spark, chunk_rows, passes):
    """Whole and cut conversations, settled by passes and by composed maps, come out alike."""
    rng = random.Random(chunk_rows)
    convs = {k: random_said(rng, rng.randrange(1, 9)) for k in range(60)}
    convs[1000] = random_said(rng, 40)
    convs[1001] = [("user", " ")] * 30 + [("assistant", "Well.")] + [("tool", f"t{i}.") for i in range(13)]
    turns = {k: [None if rng.random() < 0.1 else i * 2 for i in range(len(v))] for k, v in convs.items()}
    turns = {k: sorted(v, key=lambda t: (t is not None, t or 0)) for k, v in turns.items()}
    convs = {k: [said for _, said in sorted(zip(turns[k], v), key=lambda p: (p[0] is not None, p[0] or 0, p[1][0], p[1][1][:64]))]
             for k, v in convs.items()}
    data = [(k, t, *s) for k, v in convs.items() for t, s in zip(turns[k], v)]
    pieces = dialogues.repair(spark.createDataFrame(data, SPEC).repartition(7), chunk_rows, passes)
    assert max(r.piece for r in pieces.collect()) >= (9 if chunk_rows < 1024 else 0)
    got = dialogues.summary(pieces)
    assert rows(got, "conv_id", "cost", "audit", "gaps", "repaired_sha256") == sorted(
        (expected(k, v, turns[k]) for k, v in convs.items()), key=repr)
    faults = {r.conv_id: (r.blank, r.duplicate, r.truncated, r.illegal) for r in got.collect()}
    for k, said in convs.items():
        codes, seen = [], set()
        for role, text in said:
            body = text.strip(dialogues.SPACE)
            codes.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        odd = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        assert faults[k] == (codes.count("b"), codes.count("d"), codes.count("t"), odd), k


def test_op11_against_sql(spark):
    df = queries.QUERIES["op11_dialogue_repair"](spark, SF)
    cur = connect(SF).execute(queries.ORACLE["op11_dialogue_repair"])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_cost_vectors_converge():
    """A chunk of ordinary turns forgets where it started; blank rows do not."""
    talk, blank = bytes([1, 2] * 10), bytes([8] * 20)
    assert len({dialogues.backward(talk, v) for v in range(len(dialogues.VECTORS))}) == 1
    assert dialogues.backward(blank, dialogues.FINAL) != dialogues.backward(blank, dialogues.SPECULATIVE)
    for codes, old, new in product((talk, blank, talk + blank), range(4), range(4)):
        assert dialogues.fix_up(codes, old, dialogues.backward(codes, old), new) == dialogues.backward(codes, new)


def test_op11_odd_rows(spark):
    """Null ids, turns, roles and texts, an empty role, repeated rows, a hot row, long text, clashing names."""
    extra = ", ".join(f"{c} string" for c in ("piece", "place", "row", "head", "h", "whole", "codes", "kind", "copy"))
    data = ([(None, None, None, None)] * 2 + [(1, None, "user", "Hi.")] * 3000
            + [(2, 0, "", "Hello."), (2, 1, "user", "x" * 70000), (3, 5, "system", "Only."), (4, 2, None, "Text.")])
    df = spark.createDataFrame([(*r, *["x"] * 9) for r in data], f"{SPEC}, {extra}").repartition(5)
    got = {r.conv_id: r for r in dialogues.summary(dialogues.repair(df, 64)).collect()}
    assert {k: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost) for k, r in got.items()} == {
        None: (0, 2, 0, 0, 1, 6), 1: (0, 0, 2999, 0, 2999, 2 + 3 * 2999), 2: (0, 0, 0, 1, 1, 5),
        3: (0, 0, 0, 0, 0, 3), 4: (0, 0, 0, 0, 0, 3)}
    assert got[1].audit == "K" + "D" * 2999 + "I" and got[None].audit == "DD" and got[3].audit == "D"
    assert got[2].audit == "RR"
    assert dialogues.summary(dialogues.repair(df.where("conv_id = -1"))).count() == 0
    assert queries.damage(df).columns == ["conv_id", "turn", "role", "text"]
