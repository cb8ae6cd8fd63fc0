"""SimHash, edited texts and the radius search against plain Python."""

import hashlib
import math
import random
import re

import pytest
import xxhash
from conftest import ODD, SMALL, rows

from tradewind.llm import fingerprints, queries

FULL = (1 << 64) - 1


def chained(parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p if isinstance(p, bytes) else p.encode(), seed)
    return seed


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    terms = [words[i:i + 5] for i in range(max(1, len(words) - 4))] if words else []
    votes = [0] * 128
    for term in terms:
        h0 = chained(term)
        h = h0 << 64 | chained([h0.to_bytes(8, "little")])
        for i in range(128):
            votes[i] += 1 if h >> i & 1 else -1
    return sum(1 << i for i, v in enumerate(votes) if v > 0)


def like(a, b):
    return max(0.0, math.cos(math.pi * (a ^ b).bit_count() / 128))


def brute_rows(docs):
    different = sorted({(i, t or "") for i, t in docs}, key=lambda d: (d[0] is not None, d[0] or 0, hashlib.md5(
        f"{'null' if d[0] is None else d[0]}:{d[1]}".encode()).digest()))
    found = {}
    prints = [brute_print(t) for _, t in different]
    for k, (i, text) in enumerate(different):
        ahead = (k + 1) % len(different)
        take = len(text) // 4
        changed = text[:len(text) - take] + different[ahead][1][:take]
        e = brute_print(changed)
        found[i, text] = (i, len(text), hashlib.sha256(changed.encode()).hexdigest(), f"{prints[k]:032x}", f"{e:032x}",
                          round(like(prints[k], e), 9), round(like(prints[k], prints[ahead]), 9))
    own = [int(found[i, t or ""][3], 16) for i, t in docs]
    out = []
    for i, t in docs:
        row = found[i, t or ""]
        near = sum((int(row[3], 16) ^ o).bit_count() <= fingerprints.RADIUS for o in own) if i is not None and i % 50 == 0 else None
        out.append((*row, near))
    return sorted(out, key=repr)


def results(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9),
                    round(r.near_next, 9), r.n_near) for r in df.collect()), key=repr)


def test_op12_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert results(queries.QUERIES["op12_simhash"](spark, SMALL)) == brute_rows(docs)


def written(spark, tmp_path, data, extra=()):
    spec = ", ".join(["doc_id long", *[f"{c} string" for c in extra], "text string"])
    spark.createDataFrame([(i, *["x"] * len(extra), t) for i, t in data], spec).write.parquet(f"{tmp_path}/documents.parquet")
    return queries.QUERIES["op12_simhash"](spark, str(tmp_path))


def test_op12_odd_rows(spark, tmp_path):
    """Null ids and texts, empty, blank and very long texts, repeated rows, one id with two texts, clashing names."""
    data = [*ODD, (50, "same"), (50, "same"), (50, "other words"), (100, ""), (150, None)]
    extra = ("key", "high", "low", "words", "edited", "copies", "h0", "next_key", "n_near")
    assert results(written(spark, tmp_path, data, extra)) == brute_rows(data)


def test_op12_none_and_one(spark, tmp_path):
    assert results(written(spark, tmp_path / "none", [])) == []
    one = [(0, "abcdefgh")]
    assert results(written(spark, tmp_path / "one", one)) == brute_rows(one)


@pytest.mark.parametrize("radius,tile", [(3, 4), (6, 4096)])
def test_within_a_radius(spark, radius, tile):
    """A dense cluster, its copies and strangers; the cluster fills more than a tile."""
    rng = random.Random(radius)
    centre = rng.getrandbits(128)
    prints = []
    for k in range(400):
        p = centre if k < 300 else rng.getrandbits(128)
        for _ in range(rng.randrange(8)):
            p ^= 1 << rng.randrange(128)
        prints += [p] * rng.choice([1, 1, 3])
    asked = prints[::9]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = lambda ps: spark.createDataFrame([(signed(p >> 64), signed(p & FULL), 1) for p in ps], "high long, low long, copies long")
    got = rows(fingerprints.within(frame(asked), frame(prints), radius, tile), "high", "low", "n_near")
    assert got == sorted(((signed(q >> 64), signed(q & FULL), sum((q ^ p).bit_count() <= radius for p in prints))
                          for q in set(asked)), key=repr)


def test_op12_likeness_tells_edits_from_strangers(spark):
    found = queries.QUERIES["op12_simhash"](spark, SMALL).where("n_chars > 500")
    low, high = found.selectExpr("percentile(near_edited, 0.05)", "percentile(near_next, 0.95)").first()
    assert low > 0.5 > high
