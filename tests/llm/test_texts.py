"""Licences, quality rules, both classifiers and decontamination against plain Python."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import ODD, SF, rows

from tradewind.llm import compression, decontaminate, licences, queries, rules, toxicity
from tradewind.llm.words import blocks, shingle_set, split_words, windows

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def texts(spark, sf=SF, n=10**9):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()][:n]


# -- words ---------------------------------------------------------------------------------------------

def test_words_and_shingles_agree_with_a_regex():
    data = [t for _, t in ODD] + ["x  y\tz", "é\u00a0b c", "A b A b"]
    for most in (1, 50, 1 << 20):
        found = []
        for block in blocks(pa.array(data, pa.string()), most):
            words = split_words(block, lower=True)
            found += [words.hashes[a:b] for a, b in zip(words.of_text[:-1], words.of_text[1:])]
        want = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER)) for t in data]
        assert [len(f) for f in found] == [len(w) for w in want]
        names = {}
        for hashes, words in zip(found, want):
            for h, w in zip(hashes.tolist(), words):
                assert names.setdefault(w, h) == h
        assert len(set(names.values())) == len(names)


def test_short_text_is_no_window():
    h = np.arange(1, 9, dtype=np.uint64)
    assert shingle_set(h[:0], 5).size == 0 and shingle_set(h[:4], 5).size == 1
    assert shingle_set(h[:4], 5)[0] != windows(h[:4], 4)[0] and shingle_set(h, 5).size == 4


# -- op1 -----------------------------------------------------------------------------------------------

def brute_phrases(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    places = [(i, label) for phrase, label in licences.PHRASES for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(places)


def test_op1_base_against_brute_force(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op1_license_scan"](spark, SF).collect()}
    for i, text in texts(spark):
        n, places = brute_phrases(text)
        row = got[i]
        assert (row["n_words"], row["n_base"]) == (n, len(places))
        assert (row["first_word"], row["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert row["base_labels"] == ",".join(sorted({p[1] for p in places})) and 0 <= row["score"] <= 1
        assert set(row["base_labels"].split(",")) <= set(row["labels"].split(",")) or not places


def test_automaton_gives_matching_statistics():
    rng = random.Random(3)
    for _ in range(200):
        parts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 8))] for _ in range(rng.randint(1, 4))]
        auto, text = licences.SuffixAutomaton(parts), [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(30)]
        got = {i: (n, auto.ends[s]) for i, s, n in auto.statistics(text)}
        for i in range(len(text)):
            runs = {n: sorted({(k, j + n) for k, p in enumerate(parts) for j in range(len(p)) if p[j:j + n] == text[i + 1 - n:i + 1]})
                    for n in range(1, i + 2)}
            best = max((n for n, places in runs.items() if places), default=0)
            assert got.get(i, (0, []))[0] == best and (not best or got[i][1] == runs[best])


def test_changed_template_is_one_span_and_a_fragment_is_none():
    label, text = licences.TEMPLATES[0]
    words = text.lower().split()
    changed = " ".join([*words[:12], "really", *words[12:30], *words[32:]])
    n, places, spans = licences.scan_text(f"before it {changed} after it")
    assert [s["label"] for s in spans] == [label] and spans[0]["covered"] > 0.8 and spans[0]["start"] == 2
    assert not licences.scan_text(" ".join(words[:8]))[2]


# -- op2, op6 ------------------------------------------------------------------------------------------

def test_op2_held_out_rows(spark):
    got = queries.QUERIES["op2_quality_classifier"](spark, SF)
    known = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    held = [r for r in known if r["held_out"]]
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count() and len(held) > 50
    right = [r["predicted"] == r["quality"] for r in held]
    assert sum(right) / len(right) >= 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in known)


def test_op2_without_labels_and_without_rows(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = compression.fit(odd, labels)
    assert {r["score"] for r in compression.score(odd, model).collect()} == {0.5}
    assert compression.score(none, model).count() == 0
    trained = compression.fit_sample([(b"good words here " * 9, 1), (b"good words here " * 9, 1),
                                      (b"#$% #$% " * 9, 0), (b"#$% #$% " * 9, 0)] * 20)
    assert trained.score(b"") == trained.rate
    assert trained.score(b"good words here good") > trained.score(b"#$% #$% #$% #$%")


def test_op6_labels(spark):
    got = queries.QUERIES["op6_toxicity"](spark, SF)
    known = got.join(spark.read.parquet(f"{SF}/labels.parquet").withColumnRenamed("toxic", "y"), "doc_id").collect()
    bad, clean = ([r["toxic"] for r in known if r["y"] == y] for y in (1, 0))
    assert sum(bad) / len(bad) > 0.85 and sum(clean) / len(clean) < 0.02
    assert got.columns == ["doc_id", "p_insult", "p_contempt", "p_toxic", "toxic"]


def test_op6_chain_feeds_earlier_categories():
    rng = random.Random(4)
    sample = []
    for _ in range(400):
        a = rng.random() < 0.5
        sample.append((f"{'badword' if a else 'goodword'} {rng.choice('xyz')} filler", [int(a), int(a)]))
    chain = toxicity.fit_sample(sample, ["first", "last"])
    assert [len(w) for w in chain.weights] == [len(chain.telling) + 1, len(chain.telling) + 2]
    block = next(blocks(pa.array(["badword x", "goodword x", ""])))
    p = chain.score(block)
    assert p[0, 1] > 0.9 > 0.1 > p[1, 1] and ((0 <= p) & (p <= 1)).all()
    changed = [chain.weights[0], chain.weights[1].copy()]
    changed[1][-2] += 5
    assert toxicity.Chain(chain.categories, chain.telling, changed).score(block)[0, 1] > p[0, 1]


def test_op6_without_labels(spark, odd):
    chain = toxicity.fit(odd, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["p_toxic"] for r in toxicity.score(odd, chain).collect()} == {0.5}


# -- op3 -----------------------------------------------------------------------------------------------

def edit_distance(item, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i] + [0] * len(text)
        for j, b in enumerate(text, 1):
            now[j] = min(before[j - 1] + (a != b), before[j] + 1, now[j - 1] + 1)
        before = now
    return min(before)


def test_myers_against_dynamic_programming():
    rng = random.Random(5)
    for _ in range(400):
        item = [rng.randrange(4) for _ in range(rng.randint(1, 70))]
        text = [rng.randrange(4) for _ in range(rng.randint(0, 80))]
        distance, a, b = decontaminate.best_match(item, text, 10**6)
        assert distance == edit_distance(item, text) == edit_distance(item, text[a:b])


@pytest.mark.parametrize("block_words", [1 << 20, 40])
def test_op3_against_brute_force(spark, block_words, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(200)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(4, 40))) for _ in range(12)]
    docs = []
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        item = rng.choice(items).split()
        for _ in range(rng.randint(0, max(1, int(0.3 * len(item))))):
            i = rng.randrange(len(item))
            item[i:i + 1] = rng.choice([[rng.choice(vocabulary)], [], [item[i], rng.choice(vocabulary)]]) or item[:0]
            item = item or ["v1"]
        at = rng.randint(0, len(words))
        docs.append(rng.choice([" ", ", ", "\n"]).join(words[:at] + item + words[at:]))
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    queries_ = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = set()
    for i, text in enumerate(docs):
        for j, item in enumerate(items):
            m = item.split()
            d = edit_distance(m, re.findall(r"\w+", text))
            if len(m) >= decontaminate.LEAST_WORDS and d <= decontaminate.budget(len(m)):
                want.add((i, j, d))
    found = decontaminate.find(frame, queries_)
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in found.collect()} == want and want
    left = {r["doc_id"] for r in decontaminate.clean(frame, queries_).collect()}
    assert left == set(range(60)) - {w[0] for w in want}


def test_op3_short_items(spark):
    """Items of one to seven words are searched for too, from five words on with a word that differs."""
    docs = ["What is the boiling point of water, they ask.", "The boiling point of sulphur is higher", "Boiling Point!", "none"]
    items = ["boiling point", "what is the boiling point of water", "None", "boiling of", "the boiling point of water", "?", None]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    given = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert rows(decontaminate.find(frame, given), "doc_id", "item_id", "distance", "n_item_words") == [
        (0, 0, 0, 2), (0, 1, 0, 7), (0, 4, 0, 5), (1, 0, 0, 2), (1, 4, 1, 5), (2, 0, 0, 2), (3, 2, 0, 1)]
    assert rows(decontaminate.clean(frame, given.where("item_id in (1, 2, 3, 5, 6)")), "doc_id") == [(1,), (2,)]


def test_op3_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, odd.where("doc_id = 6").first()["text"]), (2, None), (3, ""), (None, "a b c")],
                                  "item_id long, text string")
    assert rows(decontaminate.find(odd, items), "doc_id", "item_id", "distance") == [(5, 1, 0), (5, 1, 0), (6, 1, 0), (7, 1, 0)]
    assert decontaminate.find(none, items).count() == 0
    assert decontaminate.find(odd, items.where("item_id = 9")).count() == 0
    assert decontaminate.clean(odd, items).columns == odd.columns and decontaminate.clean(odd, items).count() == len(ODD) - 4


# -- op4 -----------------------------------------------------------------------------------------------

def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if runs[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def test_op4_against_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[1:7] for r in queries.QUERIES["op4_quality_rules"](spark, SF).collect()}
    for i, text in texts(spark):
        assert got[i] == brute_rules(text)


def test_op4_odd_rows_policies_and_ablation(odd, none):
    ledger = rules.ledger(odd)
    got = rows(ledger, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == sorted(((i, *brute_rules(t)[:5]) for i, t in ODD), key=repr)
    assert rules.ledger(none).count() == 0
    masks = [r["failed"] for r in ledger.collect()]
    policies = [rules.BASE, rules.STANDARD, rules.STRICT]
    found = {(r["policy"], r["rule"]): r for r in rules.ablation(ledger, policies).collect()}
    for p in policies:
        assert rules.decide(ledger, p).where("kept").count() == sum(m & p.mask == 0 for m in masks)
        for rule in p.rules:
            row, bit = found[p.name, rule], rules.BIT[rule]
            assert (row["n_docs"], row["n_rejected"]) == (len(masks), sum(m & p.mask != 0 for m in masks))
            assert (row["n_failed"], row["n_only"]) == (sum(m & bit != 0 for m in masks), sum(m & p.mask == bit for m in masks))
    kept = rules.keep(odd, rules.STANDARD)
    assert kept.columns == odd.columns and kept.count() == sum(m & rules.STANDARD.mask == 0 for m in masks)
    assert rules.keep(none, rules.BASE).count() == 0 and rules.ablation(rules.ledger(none), [rules.BASE]).count() == 2


# -- odd rows for the scorers --------------------------------------------------------------------------

def test_scorers_take_odd_rows(odd, none):
    model = compression.fit_sample([(b"good words here " * 9, 1)] * 20 + [(b"#$% #$% " * 9, 0)] * 20)
    chain = toxicity.fit_sample([("you idiot", [1, 0, 1]), ("hello there", [0, 0, 0])] * 20, [*toxicity.CATEGORIES, "toxic"])
    for run in (licences.scan, lambda d: compression.score(d, model), lambda d: toxicity.score(d, chain)):
        assert [r[0] for r in rows(run(odd), "doc_id")] == [r[0] for r in rows(odd, "doc_id")]
        assert run(none).count() == 0
    places = {r["doc_id"]: r for r in licences.scan(odd).collect()}
    assert [p["label"] for p in places[12]["places"]] == ["mit"] and places[1]["n_words"] == 0 == places[2]["n_words"]
