"""Record files and byte-pair coding against the tokenizers library, and the pipeline against plain Python."""

import glob
import hashlib
import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from conftest import ODD, PROSE, SMALL, rows
from test_joins import brute_join, brute_secrets
from test_texts import edit_distance
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradewind.llm import bpe, checksums, decontaminate, queries, records, rules
from tradewind.session import scratch

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["a", "B", "é", "É", " ", "  ", "\n", "\t", "'s", "'", "’", "1", "23", "٣", "!!", "🙂", "漢字", "\u2028", "\x1c",
        "<|endoftext|>", "ing", "THE", "İ", "ß", "ﬁ", "\u0301", "_", "\u212b", "Σ", "ΑΣ", ". ", ", ", ".,", "?. ", "word. "]


def mixed(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_crc32c():
    def slow(data):
        crc = 0xFFFFFFFF
        for byte in data:
            crc ^= byte
            for _ in range(8):
                crc = (crc >> 1) ^ (checksums.POLYNOMIAL if crc & 1 else 0)
        return crc ^ 0xFFFFFFFF
    rng = random.Random(1)
    raw = np.frombuffer(b"123456789" + rng.randbytes(9000), np.uint8)
    starts = np.array([0] + [rng.randrange(3000) for _ in range(30)])
    sizes = np.array([9] + [rng.choice([0, 1, 2, 255, 256, 257, 512, 3001]) for _ in range(30)])
    got = checksums.crc32c(raw, starts, sizes).tolist()
    assert got[0] == 0xE3069283 and got == [slow(raw[a:a + n].tobytes()) for a, n in zip(starts, sizes)]


def test_word_encoder_is_the_library():
    encoder, texts = records.WordEncoder(WORD), mixed(2, 2000)
    want = encoder.library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(e, "<u2").tolist() for e in encoder.encode(texts)] == [w.ids for w in want]


def test_op7_against_the_library(spark):
    library = Tokenizer.from_file(WORD)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    start, want = 0, []
    for r in docs:
        ids = np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows(queries.QUERIES["op7_token_records"](spark, SMALL)) == sorted(want, key=repr)


def test_op7_odd_rows_shuffled_reads_and_damage(spark, odd, none):
    folder = scratch(spark, "records-test")
    records.write(odd, folder, WORD, end_id=2)
    found = records.index(spark, folder)
    assert found.count() == len(ODD) and found.agg({"start": "min"}).first()[0] == 0
    by_id = sorted(found.collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in by_id]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(by_id, by_id[1:]))
    back = {(r["start"]): bytes(r["ids"]) for r in records.read(found.orderBy("length"), folder).collect()}
    assert len(back) == len(ODD) and back[by_id[2]["start"]] == (2).to_bytes(4, "little")
    empty = scratch(spark, "records-none")
    records.write(none, empty, WORD, end_id=2)
    assert records.read(records.index(spark, empty), empty).count() == 0
    path = glob.glob(f"{folder.removeprefix('file://')}/shards/*.rec")[0]
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="checksum|index says"):
        records.read(found, folder).collect()


def test_encoder_is_the_library_and_decoder_too():
    library, encoder = Tokenizer.from_file(BYTE), bpe.encoder_of(BYTE)
    decoder, rng = bpe.Decoder(encoder.vocabulary), random.Random(3)
    long = ["a" * 9000, "ab" * 70000, "é" * 70000 + " x", " " * 70000 + "x", "!" * 140000,
            "".join(rng.choice("etaoinshr") for _ in range(100000))]
    for text in [*mixed(4, 1500), *long]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
        assert decoder.feed(want) + decoder.finish() == library.decode(want, skip_special_tokens=False)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(40)]
        assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("window", [None, 1, 2, 3, 7])
def test_contractions_at_window_borders(monkeypatch, window):
    """Every contraction, slid over a border of the windows one character at a time, and small windows."""
    library, encoder = Tokenizer.from_file(BYTE), bpe.encoder_of(BYTE)
    if window:
        monkeypatch.setattr(bpe, "WINDOW", window)
    words = ["they're", "we've", "we'll", "it's", "don't", "I'm", "he'd", "x 're", "x''ve", "a  'll"]
    texts = [("ab " * bpe.WINDOW)[:bpe.WINDOW - back] + word + " so" for word in words for back in range(len(word) + 2)
             if back <= bpe.WINDOW]
    for text in texts + (mixed(6, 400) if window else []):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text[-40:]


def test_frequent_pieces_stay_cached(monkeypatch):
    """A pre-token that keeps coming is merged once however many others pass; the cache stays within its size."""
    monkeypatch.setattr(bpe, "CACHED", 64)
    encoder, made = bpe.Encoder(bpe.vocabulary_of(BYTE)), []
    cache = bpe._Cache(lambda piece: made.append(piece) or encoder._piece(piece))
    for i in range(1000):
        for piece in (" the", f" w{i}"):
            assert cache[piece] == encoder._piece(piece)
        assert len(cache) + len(cache.other) <= 64
    assert made.count(" the") == 1


def test_explicit_classes_cut_as_the_pattern():
    """Every character of the basic plane beside a letter, a digit, a mark and white space; others take the pattern itself."""
    whole = bpe.regex.compile(bpe.PRE_TOKEN)
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    for beside in ("a", "1", "!", " ", "'s", "\n", "  "):
        text = beside.join(chars)
        assert bpe.basic_cut().findall(text) == whole.findall(text)
    library, encoder = Tokenizer.from_file(BYTE), bpe.encoder_of(BYTE)
    for text in ("\U0001F600 \U00010400b\U0001D7D8 1", "x\U0001D400's  \U00020000 "):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_lookahead_settles_tokens():
    """With any merge list, tokens that end further from the end than the bound are the same for every continuation."""
    rng = random.Random(5)
    for _ in range(60):
        tokens, merges = ["a", "b", "c"], []
        while len(merges) < 12:
            pair = rng.choice(tokens), rng.choice(tokens)
            if pair not in merges and "".join(pair) not in tokens:
                merges.append(pair)
                tokens.append("".join(pair))
        ids = {t: i for i, t in enumerate(tokens)}
        bound = bpe.lookahead([(ids[a], ids[b], ids[a + b], len(a)) for a, b in merges])

        def cut(text):
            parts = list(text)
            for a, b in merges:
                i = 0
                while i < len(parts) - 1:
                    if (parts[i], parts[i + 1]) == (a, b):
                        parts[i:i + 2] = [a + b]
                    i += 1
            return parts

        for _ in range(40):
            text = "".join(rng.choice("abc") for _ in range(60))
            whole, at, settled = cut(text), 0, []
            for t in cut(text[:45]):
                at += len(t)
                if at <= 45 - bound:
                    settled.append(t)
            assert whole[:len(settled)] == settled


def test_op8_against_the_library(spark):
    library = Tokenizer.from_file(BYTE)
    want = []
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r["doc_id"], len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text))))
    assert rows(queries.QUERIES["op8_bpe_round_trip"](spark, SMALL)) == sorted(want, key=repr)


def test_op8_odd_rows(odd, none):
    encoded = bpe.encode(odd, BYTE)
    assert rows(bpe.decode(encoded, BYTE)) == sorted(((i, t or "") for i, t in ODD), key=repr)
    assert bpe.decode(bpe.encode(none, BYTE), BYTE).count() == 0


def brute_pipeline(docs, items):
    from test_texts import brute_rules  # noqa: PLC0415
    kept = []
    for i, text in docs:
        n, chars, symbols, _, _, base = brute_rules(text)
        words, letters = text.split(), [c for c in text if c.isascii() and c.isalpha()]
        double = sum(a == b for a, b in zip(words, words[1:]))
        capitals = sum(c.isupper() for c in letters)
        if not (base or 10 * symbols > chars or chars < 2 * n or chars > 25 * n or 100 * double > 40 * n
                or len(letters) >= 20 and 2 * capitals > len(letters)):
            kept.append((i, text))
    first = {c for i, _, c in brute_join(kept)}
    kept = [d for d in kept if d[0] in first]
    cut = lambda t: [w.decode() for w in __import__("tradewind.llm.licences", fromlist=["x"]).words_of(t)]
    items = [cut(t) for t in items]
    kept = [(i, t) for i, t in kept
            if not any(len(m) >= decontaminate.LEAST_WORDS and edit_distance(m, cut(t)) <= decontaminate.budget(len(m)) for m in items)]
    out = []
    for i, text in kept:
        at, clean = 0, ""
        for span in filter(None, brute_secrets(text).split(",")):
            kind, a, b = span.split(":")
            if int(a) >= at:
                clean += text[at:int(a)] + f"[{kind}]"
            at = max(at, int(b))
        out.append((i, clean + text[at:]))
    return out


def test_pipeline_against_plain_python(spark):
    """The registered query over the whole table, its long documents included."""
    docs = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert max(len(t) for _, t in docs) > 10000
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    library = Tokenizer.from_file(BYTE)
    want = sorted((i, library.encode(t, add_special_tokens=False).ids) for i, t in brute_pipeline(docs, items))
    found = corpus_pipeline.QUERIES["pipeline"](spark, SMALL)
    assert sorted((r["doc_id"], r["ids"]) for r in found.collect()) == want and len(want) > 50


def test_pipeline_keeps_one_row_of_each_group(spark):
    """Also where an id has several texts, none or several rows: one row a group stays, and all unique texts do."""
    rng = random.Random(8)
    one, two, three, unique = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    docs = [(1, one), (2, one + " more"), (2, unique), (None, two), (None, two), (None, two + " more"), (3, three),
            (3, three), (4, three), (None, one), (None, "  "), (None, "  "), (5, ""), (5, ""), (6, None)]
    frame = spark.createDataFrame([(text, i, "x") for i, text in docs], "text string, doc_id long, lang string")
    got = corpus_pipeline.near_duplicates(spark, frame, SMALL)
    assert got.columns == frame.columns
    found = [(r["doc_id"], r["text"]) for r in got.collect()]
    rest = [f for f in found if f[1] and f[1].startswith(two)]
    assert len(rest) == 1 and rest[0][0] is None
    found.remove(rest[0])
    assert sorted(found, key=repr) == sorted([(1, one), (2, unique), (3, three), (None, "  "), (None, "  "), (5, ""), (5, ""),
                                              (6, None)], key=repr)


def test_pipeline_stages_take_odd_rows(spark, odd, none):
    """Also with columns of the stages' own names. Of the odd rows the prose stays, once."""
    more = {c: F.lit("x") for c in ("__hash", "__held", "__told", "__best", "kept_ids", "decoded")}
    for given, left in ((odd, [(5, PROSE)]), (none, [])):
        docs = given = given.withColumns(more)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
            assert name == "bpe_encode" or docs.columns == given.columns
        assert [(r["doc_id"], r["decoded_sha256"]) for r in docs.collect()] == [
            (i, hashlib.sha256(t.encode()).hexdigest()) for i, t in left]
    assert rules.STANDARD.version == 1
