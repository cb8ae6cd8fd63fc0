"""Secret scans with a trigram inverted index, in DataFrame operations only.

Each rule's regular expression yields a Boolean query over trigrams that every match must hold.
``postings`` lists which documents hold which of those trigrams, ``shortlist`` intersects the
postings into the documents each rule has to look at, and only there is the expression run. Rules
without a trigram that every match must hold look at all documents.
"""

from __future__ import annotations

import itertools
import re
import string
from dataclasses import dataclass
from functools import cached_property
from re import _constants as sre
from re import _parser as sre_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    Patterns must mean the same to Java and RE2, be ASCII, and match no empty text.
    """
    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @cached_property
    def trigrams(self) -> tuple[frozenset[str], ...] | None:
        """Alternatives, each a set of lower-case trigrams; one of them is in every text that matches.

        None where a match need not hold any trigram.
        """
        best = None
        for strings in _required(sre_parser.parse(self.pattern)):
            if all(len(s) >= 3 for s in strings):
                sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
                sets = {a for a in sets if not any(b < a for b in sets)}  # another asks for less
                if best is None or (len(sets), -min(map(len, sets))) < (len(best), -min(map(len, best))):
                    best = sets
        return None if best is None else tuple(sorted(best, key=sorted))


def _letters(word: str) -> str:
    """A pattern for the word in either case."""
    return "".join(f"[{c}{c.upper()}]" if c in string.ascii_lowercase else c for c in word)


# The three base rules, in the order in which spans with one start are listed.
BASE = (
    Rule("assign", "(" + "|".join(_letters(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
         + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=8),
    Rule("access", "AKIA[A-Z0-9]+", least=16),
    Rule("hex", "[0-9a-f]+", least=32),
)
# A private key from its header on, with the fields of an encrypted one, also with line
# ends written as \n. Without an END line, all base64 and white space that follow count as the key.
_BREAK = r"[\\nr\x20\t\r\n]*"
PEM = (r"-----BEGIN [A-Z ]*PRIVATE KEY-----" + _BREAK
       + r"(?:Proc-Type:\x20*4,ENCRYPTED" + _BREAK + r"(?:DEK-Info:\x20*[A-Z0-9-]+(?:,[0-9A-Fa-f]+)?)?)?"
       + r"[A-Za-z0-9+/=\\\x20\t\r\n]*(?:-----END [A-Z ]*PRIVATE KEY-----)?")
# Public formats of other credentials.
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("stripe", "[rs]k_live_[A-Za-z0-9]+", least=24),
    Rule("pem", PEM),
)
RULES = BASE + MORE


def _required(parsed) -> list[list[str]]:
    """Sets of lower-case strings, one string of each of which is in every match."""
    found, open_ = [], [""]

    def close() -> None:
        nonlocal open_
        found.append(open_)
        open_ = [""]

    for op, value in parsed:
        exact = _exact(op, value)
        if exact is not None and len(open_) * len(exact) <= MOST_STRINGS:
            open_ = sorted({a + b for a in open_ for b in exact})
            continue
        close()
        if exact is not None:
            open_ = exact
        elif op is sre.SUBPATTERN:
            found += _required(value[-1])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0:
            found += _required(value[2])
    close()
    return found


def _exact(op, value) -> list[str] | None:
    """All the lower-case strings an element can match, if they are few."""
    if op is sre.LITERAL:
        return [chr(value).lower()]
    if op is sre.IN:
        if any(kind not in (sre.LITERAL,) for kind, _ in value):
            return None
        chars = {chr(x).lower() for _, x in value}
        return sorted(chars) if len(chars) <= 8 else None
    if op is sre.SUBPATTERN:
        return _sequence(value[-1])
    if op is sre.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        if any(p is None for p in parts):
            return None
        return sorted({s for p in parts for s in p})
    if op is sre.MAX_REPEAT and value[1] <= 1:
        inner = _sequence(value[2])
        return None if inner is None else sorted({s for n in range(value[0], value[1] + 1)
                                                  for s in (inner if n else [""])})
    return None


def _sequence(parsed) -> list[str] | None:
    strings = [""]
    for op, value in parsed:
        exact = _exact(op, value)
        if exact is None or len(strings) * len(exact) > MOST_STRINGS:
            return None
        strings = [a + b for a, b in itertools.product(strings, exact)]
    return strings


def vocabulary(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for r in rules if r.trigrams for one in r.trigrams for t in one})


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The inverted index: (trigram, doc_id) for each trigram of the rules' queries in a lower-cased text.

    Trigrams that no rule asks for are not listed. A null or empty text has no postings.
    """
    low = F.col("low")
    held = F.array_compact(F.array(*[F.when(low.contains(t), F.lit(t)) for t in vocabulary(rules)]))
    return (docs.select(F.col(id_col).alias("doc_id"), F.lower(F.col(text_col)).alias("low"))
            .select(F.explode(held).alias("trigram"), "doc_id"))


def shortlist(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Documents with the rules they may match: ``doc_id`` and ``rules``, a bit for each rule.

    The postings are intersected by combining the trigrams of a document into words of bits, before
    and after the shuffle; a trigram that very many documents hold has no task of its own.
    """
    words = vocabulary(rules)
    number = F.element_at(F.create_map(*[F.lit(x) for i, t in enumerate(words) for x in (t, i)]), F.col("trigram"))
    bits = lambda part: F.when(F.col("n").between(64 * part, 64 * part + 63),
                               F.call_function("shiftleft", F.lit(1).cast("long"), F.col("n") % 64)).otherwise(F.lit(0))
    parts = range((len(words) + 63) // 64)
    held = (index.withColumn("n", number).groupBy("doc_id")
            .agg(*[F.bit_or(bits(p)).alias(f"held{p}") for p in parts])) if words else None
    if held is None:
        return index.select("doc_id", F.lit(0).cast("long").alias("rules")).limit(0)

    def holds(trigrams: frozenset[str]) -> Column:
        found = F.lit(True)
        for p in parts:
            mask = sum(1 << (i % 64) for i, t in enumerate(words) if i // 64 == p and t in trigrams)
            mask -= (mask >> 63) << 64
            if mask:
                found = found & (F.col(f"held{p}").bitwiseAND(F.lit(mask)) == F.lit(mask))
        return found

    asked = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        if rule.trigrams:
            hit = F.lit(False)
            for one in rule.trigrams:
                hit = hit | holds(one)
            asked = asked.bitwiseOR(F.when(hit, F.lit(1 << i)).otherwise(F.lit(0)))
    return held.select("doc_id", asked.alias("rules")).where(F.col("rules") != 0)


def rule_spans(rule: Rule, number: int, text: Column) -> Column:
    """Spans of one rule as array<struct<start, number, end>>, code points, leftmost and not overlapping."""
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length)
    steps = F.arrays_zip(F.transform(gaps, F.char_length).alias("gap"),
                         F.transform(found, F.char_length).alias("len"), sizes.alias("size"))
    empty = F.array().cast("array<struct<start:long,number:int,end:long>>")
    # the last gap has no match behind it: its length is null and it adds no span
    walked = F.aggregate(
        steps, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + F.coalesce(s["len"], F.lit(0))).alias("at"),
            F.when(s["size"] >= rule.least, F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + s["gap"]).alias("start"), F.lit(number).alias("number"),
                (acc["at"] + s["gap"] + s["len"]).alias("end"))))).otherwise(acc["spans"]).alias("spans")))
    return walked["spans"]


def worth_scanning(rule: Rule, text: Column) -> Column:
    """A cheap test for rules without trigrams: a run of the least length, where the pattern is one run."""
    run = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return text.rlike(f"{run[1]}{{{rule.least}}}") if run and rule.group == 0 else F.lit(True)


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """The input with ``secret_spans``: array<struct<kind, start, end>> by start, then rule order.

    All columns of the input stay; one named ``secret_spans`` is replaced. Null and empty texts have
    an empty array. Rows are matched to the shortlist by id, null ids to each other; rows that share
    an id share its shortlist and are then verified one by one, so their results are their own.
    """
    docs = docs.drop("secret_spans")
    asked = shortlist(postings(docs, rules, id_col, text_col), rules).select(
        F.col("doc_id").alias("__secret_id"), F.col("rules").alias("__secret_rules"))
    # the short side is hashed, so that no text is sorted; a skewed id is split by AQE
    rows = docs.join(asked.hint("shuffle_hash"), docs[id_col].eqNullSafe(asked["__secret_id"]), "left")
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<start:long,number:int,end:long>>")
    parts = []
    for i, rule in enumerate(rules):
        if rule.trigrams:
            test = F.coalesce(F.col("__secret_rules"), F.lit(0)).bitwiseAND(F.lit(1 << i)) != 0
        else:
            test = worth_scanning(rule, text)
        parts.append(F.when(test, rule_spans(rule, i, text)).otherwise(none))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform(F.array_sort(F.flatten(F.array(*parts))), lambda s: F.struct(
        F.element_at(kinds, s["number"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.withColumn("secret_spans", spans).drop("__secret_id", "__secret_rules")


def redact(found: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace each span of ``secret_spans`` by ``[kind]`` and drop that column.

    Where spans overlap, the part that an earlier one has covered is not replaced again.
    """
    text = F.col(text_col)
    end = F.char_length(text).cast("long")
    walked = F.aggregate(
        F.col("secret_spans"), F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(
                acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["out"]).alias("out")))
    clean = F.when(F.size("secret_spans") == 0, text).otherwise(F.concat(
        walked["out"], F.substring(text, (walked["at"] + 1).cast("int"), (end - walked["at"]).cast("int"))))
    return found.withColumn(text_col, clean).drop("secret_spans")
