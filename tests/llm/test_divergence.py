"""The source divergence audit against its SQL and exact Python."""

import collections
import re

import numpy as np
import pytest
from conftest import ODD, SF, rows
from oracle import connect, rows_of

from tradewind.llm import divergence, queries


def brute(docs):
    """Rows (lang, source, part, item, value, rank) of (lang, source, text)."""
    docs = [tuple(x or "" for x in d) for d in docs]
    held, seen = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, text in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        held[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for t, n in seen[lang].items() if n >= 3]
        groups = {s: c for (g, s), c in held.items() if g == lang}
        v = len(kept)

        def p(counts):
            total = sum(counts[t] for t in kept) + v
            return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept}
        everywhere = p(sum(groups.values(), collections.Counter()))
        own = {s: p(c) for s, c in groups.items()}
        cost = lambda a, b: (a - b) ** 2 // b
        for s in groups:
            pair = [(r, sum(cost(own[s][t], own[r][t]) for t in kept)) for r in groups if r != s]
            term = [(t, cost(own[s][t], everywhere[t])) for t in kept if groups[s][t] and own[s][t] > everywhere[t]]
            for part, found, most in (("pair", pair, None), ("term", term, 200)):
                found.sort(key=lambda f: (-f[1], f[0].encode()))
                out += [(lang, s, part, i, value, k) for k, (i, value) in enumerate(found[:most], 1)]
    return sorted(out, key=repr)


def audited(docs, **sizes):
    audit = divergence.Audit(docs)
    return rows(divergence.ranked(audit.pairs(**sizes), "pair").unionByName(
        divergence.ranked(audit.telling(), "term", divergence.MOST_TERMS)))


def test_op13_against_sql(spark):
    df = queries.QUERIES["op13_source_divergence"](spark, SF)
    cur = connect(SF).execute(queries.ORACLE["op13_source_divergence"])
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


@pytest.mark.parametrize("sizes", [{}, {"block_terms": 5, "tile_groups": 2}])
def test_op13_odd_rows(spark, sizes):
    """Nulls in every column, empty and long texts, a language without kept terms, repeated rows, clashing names."""
    data = [(lang, source, text) for k, (_, text) in enumerate(ODD) for lang in ("en", None)
            for source in (None, f"s{k % 5}", "hot")]
    data += [("xx", "a", "once"), ("xx", "b", "twice"), ("xx", "c", None), ("en", "empty", ""), ("en", "empty", None)]
    extra = ("n", "term", "docs", "v", "total", "block", "tile", "item")
    df = spark.createDataFrame([(*d, *["x"] * len(extra)) for d in data],
                               "lang string, source string, text string, " + ", ".join(f"{c} string" for c in extra))
    assert audited(df.repartition(4), **sizes) == brute(data)
    assert audited(df.where("lang = 'none'"), **sizes) == []


def test_terms_over_piece_borders(monkeypatch):
    """A text is split in pieces without cutting a word."""
    text = " ".join(f"Wörd{'x' * (i % 7)}!{i}" for i in range(300)).encode()
    whole = divergence.terms_of(text)
    for piece in (1, 2, 7, 50):
        monkeypatch.setattr(divergence, "PIECE", piece)
        assert divergence.terms_of(text) == whole


def test_shared_and_shares():
    rng = np.random.default_rng(5)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in "ab")
        at_a, at_b = divergence.shared(a, b)
        assert sorted(a[at_a]) == sorted(b[at_b]) == sorted(set(a) & set(b)) and (a[at_a] == b[at_b]).all()
    for n, total in ((0, 1), (9, 10), (10**13, 3 * 10**13), (123456789, 10**12 + 7), (2 * 10**14, 27 * 10**13)):
        assert divergence.shares(np.array([n]), total)[0] == 1 + 10**9 * (n + 1) // total
