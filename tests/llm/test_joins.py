"""The Jaccard join, components, url filters and secrets against plain Python and SQL."""

import collections
import random
import re

import duckdb
import numpy as np
import pytest
from conftest import ODD, PROSE, SF, SMALL, rows
from oracle import connect

from tradewind.llm import jaccard, queries, secrets, urls
from tradewind.llm.components import components

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def merge(ids, links):
    over = {i: i for i in ids}

    def top(x):
        while over[x] != x:
            over[x] = over[over[x]]
            x = over[x]
        return x
    for a, b in links:
        a, b = top(a), top(b)
        over[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def brute_join(docs):
    sets = []
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
        sets.append((i, {tuple(words[j:j + 5]) for j in range(max(1, len(words) - 4))} if words else set()))
    links = []
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= 75 * (len(a) + len(b) - common):
                    links.append((i, j))
    top = merge({i for i, _ in sets if i is not None}, links)
    return sorted(((i, len(s), top.get(i)) for i, s in sets), key=repr)


def test_op5_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(queries.QUERIES["op5_ngram_jaccard_join"](spark, SF)) == brute_join(docs)


@pytest.mark.parametrize("tile", [jaccard.TILE, 8])
def test_op5_hot_groups(spark, tile, monkeypatch):
    """Many copies, near copies around the threshold, and a line that everybody shares."""
    monkeypatch.setattr(jaccard, "TILE", tile)
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(10**6)}"
    line, base = [word() for _ in range(12)], [word() for _ in range(60)]
    docs = [(i, " ".join(base)) for i in range(0, 40)]
    for i in range(40, 120):
        near = list(base)
        for _ in range(rng.randint(0, 3)):
            near[rng.randrange(60)] = word()
        docs.append((i, " ".join(near)))
    docs += [(i, " ".join(line + [word() for _ in range(rng.choice([2, 5, 40]))])) for i in range(120, 200)]
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(jaccard.near_duplicates(frame)) == brute_join(docs)


def test_op5_odd_rows(odd, none):
    got = jaccard.near_duplicates(odd)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert rows(got) == brute_join(ODD)
    assert jaccard.near_duplicates(none).count() == 0


def test_tree_join_finds_what_the_bound_allows():
    rng = np.random.default_rng(8)
    sets = []
    for _ in range(300):
        base = rng.integers(0, 2**63, rng.integers(1, 90), dtype=np.uint64)
        if sets and rng.random() < 0.5:
            old = sets[rng.integers(len(sets))]
            base = np.concatenate([old[:max(1, len(old) - 3)], base[:2]])
        sets.append(np.unique(base))
    sets.sort(key=len)
    points = np.frombuffer(b"".join(map(jaccard.point_of, sets)), np.uint8).reshape(len(sets), -1)
    n, group = np.array([len(s) for s in sets]), rng.integers(0, 40, len(sets))
    got = {(a, b) for i, j in jaccard.tree_join(points, n, group) for a, b in zip(i.tolist(), j.tolist())}
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            common = len(np.intersect1d(sets[i], sets[j]))
            if group[i] != group[j] and 100 * common >= 75 * (n[i] + n[j] - common):
                assert (i, j) in got
    for i, j in got:
        bound = int(jaccard.overlap_bound(points[i:i + 1], points[j:j + 1])[0])
        assert group[i] != group[j] and bound >= jaccard.needed(n[i], n[j])
        assert bound >= len(np.intersect1d(sets[i], sets[j]))


def test_bound_holds_over_255():
    a = np.arange(0, 400 * jaccard.GROUPS, jaccard.GROUPS, dtype=np.uint64)
    p, q = (np.frombuffer(jaccard.point_of(x), np.uint8)[None] for x in (a, a[:300]))
    assert jaccard.overlap_bound(p, q)[0] == 300


def test_components_of_chains_hubs_and_loops(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000)]
    links += [(rng.randrange(6000, 7000), rng.randrange(6000, 7000)) for _ in range(600)] + links[:20]
    ids = {i for pair in links for i in pair}
    frame = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    assert dict(rows(components(frame))) == merge(ids, links)
    assert components(frame.where("a = -1")).count() == 0


# -- op9 -----------------------------------------------------------------------------------------------

def brute_secrets(text):
    """Spans by Python's own matcher, which finds the same leftmost matches."""
    found = []
    for number, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), number, m.end(), rule.kind))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))


TRICKY = [
    'token = "0123456789abcdef0123456789abcdef"', "TOKEN:abcdefgh api_key='12345678' ApiKey=short token=secret=abcdefgh12",
    "api_key api_key:xxxxxxxx", "AKIA" + "A" * 12, "xAKIA" + "B" * 11 + " AKIAAKIA" + "C" * 20, "é🙂 passwd: 'abcdefghi' é",
    "f" * 31, "g" + "0" * 40 + "g", "ghp_" + "a" * 36, "xoxb-123456789012-abc", "-----BEGIN RSA PRIVATE KEY-----",
    "sk_live_" + "4" * 24, "Password  =  \"" + "q" * 9, "\u212aey to\u212aen=abcdefgh1", "",
]


def test_op9_tricky_texts(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY)] + [(None, TRICKY[0]), (0, TRICKY[3])],
                                 "doc_id long, text string")
    found = secrets.find(docs)
    for r in found.collect():
        assert ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["secret_spans"]) == brute_secrets(r["text"])
    for r in secrets.redact(found).collect():
        assert r["text"] == "" or "secret_spans" not in r.asDict()
        assert not re.search("0123456789abcdef|AKIA[A-Z]{12}|ghp_a|xoxb-1", r["text"])
        assert ("[" in r["text"]) == any(r["text"] not in (t, "") for t in TRICKY if t == r["text"]) or "[" in r["text"] or r["text"] in TRICKY


def test_op9_every_match_holds_its_trigrams():
    for rule in secrets.RULES:
        for text in TRICKY:
            for m in re.finditer(rule.pattern, text):
                low = m[0].lower()
                if rule.trigrams:
                    assert any(all(t in low for t in one) for one in rule.trigrams), (rule.kind, m[0])
    assert next(r for r in secrets.RULES if r.kind == "hex").trigrams is None


def test_op9_and_op10_match_their_sql(spark):
    con = connect(SMALL)
    for name in ("op9_secret_scan", "op10_url_filters"):
        got = queries.QUERIES[name](spark, SMALL)
        cur = con.execute(queries.ORACLE[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(got.columns)
        assert rows(got, *names) == sorted(cur.fetchall(), key=repr)


def test_op9_takes_whole_private_keys(spark, tmp_path):
    """Header, key and END line are one span, in Java, Python and DuckDB alike, and nothing of the key stays."""
    body = "\n".join("MIIEvQ" + c * 58 for c in "aB3+/") + "\nnrQ=="
    head, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    fields = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n"
    whole = f"{head}\n{body}\n{end}"
    texts = {
        f"é {whole} after": "é [pem] after", f"a\n{head}\n{fields}{body}\n{end}\nb": "a\n[pem]\nb",
        whole.replace("\n", "\r\n") + "\r\nb": "[pem]\r\nb", whole.replace("\n", "\n\t  "): "[pem]",
        '{"k": "' + whole.replace("\n", "\\n") + '\\n", "x": 1}': '{"k": "[pem]\\n", "x": 1}',
        '"' + f"{head}\n{fields}{body}\n{end}".replace("\n", "\\r\\n") + '"': '"[pem]"',
        f"cut off: {head}\n{body}": "cut off: [pem]", f"{head}{body}{end}{whole}": "[pem][pem]", head: "[pem]",
        f"{head}\nMII": "[pem]", f"{whole}\n{end}": f"[pem]\n{end}", f"{head} " + "Q" * 200000 + f" {end}.": "[pem].",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secrets.find(docs)
    for r in found.collect():
        assert ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["secret_spans"]) == brute_secrets(r["text"])
    assert [r["text"] for r in secrets.redact(found).orderBy("doc_id").collect()] == list(texts.values())
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(f"select doc_id, spans from ({queries.ORACLE['op9_secret_scan']}) order by doc_id").fetchall()
    assert want == sorted(rows(queries.QUERIES["op9_secret_scan"](spark, str(tmp_path)), "doc_id", "spans"))


def test_op9_odd_rows(odd, none):
    found = secrets.find(odd)
    assert found.count() == len(ODD) and set(found.columns) == set(odd.columns)
    assert secrets.find(none).count() == 0
    kept = secrets.redact(secrets.find(odd.drop("secret_spans")))
    assert sorted(kept.columns) == sorted(c for c in odd.columns if c != "secret_spans")
    clean = {r["doc_id"]: r["text"] for r in kept.collect() if r["doc_id"] in (1, 2, 6, 12)}
    assert clean == {1: None, 2: "", 6: PROSE, 12: "MIT License. [assign]' [access] [hex]"}


# -- op10 ----------------------------------------------------------------------------------------------

def test_cascade_is_exact_over_its_universe(spark):
    rng = random.Random(10)
    every = [f"k{rng.randrange(10**9)}" for _ in range(3000)]
    for n in (0, 1, 40, 3000):
        listed = set(every[:n])
        universe = spark.createDataFrame([(k,) for k in every + every[:5] + [None]], "key string")
        cascade = urls.build(spark.createDataFrame([(k,) for k in [*listed, None]], "key string"), universe)
        got = {r["key"]: r["m"] for r in universe.select("key", cascade.member(universe["key"]).alias("m")).collect()}
        assert {k for k, m in got.items() if m} == listed
        if n == 40:
            assert len(cascade.levels) > 1
    with pytest.raises(ValueError, match="bound"):
        urls._fill(spark.range(1).selectExpr("'x' as key"), 0, 10**8, 1e-6)


def brute_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0] if rest else ""
    host = host.translate(UPPER)
    fits = [(len(h + p), h + p, v) for pairs, v in ((urls.ALLOW, "allow"), (urls.BLOCK, "block")) for h, p in pairs
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[1:]
    bad = any(host == h or host.endswith("." + h) for h, _ in urls.BLOCKED_HOSTS)
    return host, path, None, "block" if bad else "allow"


def test_op10_odd_urls(spark):
    given = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/en/1?x#y", "http://example.org", "http://example.org/",
             "http://xexample.org/en/12", "http://a.b.example.org/es/", "http://com/fr/x", "http://x.com/fr", "http://x.com/de/1",
             "http://a://b.org/x", "http://é.org/ü", "http://casino-win.example.net", "http://b.casino-win.example.net?q",
             "http://x.org#/es/", "http://example.org\n/en/1", "." * 3000, "http://" + "a." * 3000 + "org/", "http://org"]
    pages = spark.createDataFrame([(i, u, "x", "x") for i, u in enumerate(given)] + [(None, given[4], "x", "x"), (3, given[3], "x", "x")],
                                  "page_id long, url string, host string, keys string")
    got = urls.judge(pages, list(urls.ALLOW), list(urls.BLOCK))
    want = sorted([(i, *brute_url(u)) for i, u in enumerate(given)] + [(None, *brute_url(given[4])), (3, *brute_url(given[3]))], key=repr)
    assert rows(got) == want
    assert urls.judge(pages.where("page_id = -1"), list(urls.ALLOW), list(urls.BLOCK)).count() == 0
    assert collections.Counter(r["verdict"] for r in got.collect())["block"] >= 4
