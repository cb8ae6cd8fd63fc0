"""The registered queries of the operators, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (bpe, compression, decontaminate, dialogues, divergence, fingerprints, jaccard, licences, records, rules,
                           secrets, toxicity, urls)
from tradewind.session import scratch, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and template spans of every document; the score is the best share of a template."""
    rows = licences.scan(table(spark, sf_dir, "documents"))
    base, spans = F.col("places.label"), F.col("spans.label")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    score = F.greatest(F.coalesce(F.array_max("spans.covered"), F.lit(0.0)),
                       F.when(F.size("places") > 0, 0.5).otherwise(0.0))
    return rows.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                       F.array_min("places.start").alias("first_word"),
                       F.array_max("places.start").alias("last_word"), joined(base).alias("base_labels"),
                       joined(F.concat(base, spans)).alias("labels"), score.alias("score"))


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compression score of every document; held-out rows show how it does on labels not learned."""
    docs = table(spark, sf_dir, "documents")
    model = compression.fit(docs, table(spark, sf_dir, "labels"))
    return compression.score(docs, model).select(
        "doc_id", compression.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op3_benchmark_decontamination")
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item within the word budget, with the item."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


RULES_SQL = f"""
with texts as (
  select row_number() over () as r, doc_id, coalesce(text, '') as body,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents),
runs as (
  select r, i, count(*) over (partition by r, array_to_string(words[i:i + 7], ' ')) as times
  from texts, unnest(range(1, len(words) - 6)) as t(i)),
covered as (
  select r, count(distinct i + k) as n from runs, range(0, 8) as t(k) where times > 1 group by r),
counts as (
  select doc_id, len(words) as n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(lines) as n_lines,
         len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words,
         len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) as doubled,
         length(regexp_replace(body, '[^A-Za-z]', '', 'g')) as letters,
         length(regexp_replace(body, '[^A-Z]', '', 'g')) as capitals
  from texts left join covered using (r)),
judged as (
  select *, n_words < 20 as few_words, 100 * n_repeat_words > 30 * n_words as repeated_windows,
         10 * n_symbols > word_chars as many_symbols, 100 * n_dup_lines > 30 * n_lines as duplicate_lines,
         word_chars < 2 * n_words as short_words, word_chars > 25 * n_words as long_words,
         100 * doubled > 40 * n_words as repeated_words,
         letters >= 20 and 2 * capitals > letters as shouting
  from counts)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {" or ".join(rules.BASE.rules)} as base_failed,
       not ({" or ".join(rules.STANDARD.rules)}) as kept,
       ({" + ".join(f"{name}::bigint * {bit}" for name, bit in rules.BIT.items())})::bigint as failed
from judged"""


@query("op4_quality_rules", RULES_SQL)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of every document with the base verdict and the standard policy's."""
    rows = rules.decide(rules.ledger(table(spark, sf_dir, "documents")), rules.STANDARD)
    base = F.col("failed").bitwiseAND(F.lit(rules.BASE.mask)) != 0
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base.alias("base_failed"), "kept", "failed")


@query("op5_ngram_jaccard_join")
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and near-duplicate component of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chained category probabilities of every document; toxic from one half on."""
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, chain).withColumn("toxic", F.col("p_toxic") >= 0.5)


@query("op7_token_records")
def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as read back from the record files."""
    folder = scratch(spark, "records")
    records.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    found = records.read(records.index(spark, folder), folder)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op8_bpe_round_trip")
def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, with digests of the ids and of the decoded text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    return bpe.decode(encoded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def _span_sql(rule: secrets.Rule, number: int) -> str:
    """Spans of one rule as a list of structs, in DuckDB's SQL."""
    pattern = rule.pattern.replace("'", "''")
    return f"""(
    select list_filter(list_transform(range(1, len(found) + 1), lambda i: {{
             'start': coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
                      + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0),
             'number': {number}, 'kind': '{rule.kind}', 'len': length(found[i]), 'size': length(parts[i])}}),
             lambda s: s.size >= {rule.least})
    from (select string_split_regex(body, '{pattern}') as gaps,
                 regexp_extract_all(body, '{pattern}', 0) as found,
                 regexp_extract_all(body, '{pattern}', {rule.group}) as parts))"""


SECRET_SQL = f"""
with bodies as (select doc_id, coalesce(text, '') as body from documents),
spans as (
  select doc_id, {", ".join(f"{_span_sql(r, i)} as s{i}" for i, r in enumerate(secrets.RULES))} from bodies),
sorted as (
  select doc_id, len(s0) as n_assign, len(s1) as n_access, len(s2) as n_hex,
         list_sort(list_concat({", ".join(f"s{i}" for i in range(len(secrets.BASE)))})) as base,
         list_sort(list_concat({", ".join(f"s{i}" for i in range(len(secrets.RULES)))})) as every
  from spans)
select doc_id, n_assign, n_access, n_hex,
       sha256(array_to_string(list_transform(base,
              lambda s: s.kind || ':' || s.start::bigint || ':' || (s.start + s.len)::bigint), ',')) as base_sha256,
       array_to_string(list_transform(every,
              lambda s: s.kind || ':' || s.start::bigint || ':' || (s.start + s.len)::bigint), ',') as spans
from sorted"""


@query("op9_secret_scan", SECRET_SQL)
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all kinds in every document, and the base kinds counted and digested."""
    rows = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", *(
        s[k].cast("string") for k in ("kind", "start", "end")))), ",")
    of = lambda *kinds: F.filter("secret_spans", lambda s: s["kind"].isin(*kinds))
    return rows.select("doc_id", *[F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE],
                       F.sha2(shown(of(*[r.kind for r in secrets.BASE])), 256).alias("base_sha256"),
                       shown(F.col("secret_spans")).alias("spans"))


def _pairs(pairs: tuple[tuple[str, str], ...], verdict: str) -> str:
    return ", ".join(f"('{h}', '{p}', '{verdict}')" for h, p in pairs)


@query("op10_url_filters", f"""
with parts as (
  select page_id, url, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
hosts as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parts),
urls as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from hosts),
rules(rule_host, rule_path, verdict) as (values {_pairs(urls.ALLOW, 'allow')}, {_pairs(urls.BLOCK, 'block')}),
bad(bad_host, bad_path, verdict) as (values {_pairs(urls.BLOCKED_HOSTS, 'block')}),
best as (
  select u.page_id, u.host, u.path, max_by(rule_host || rule_path, length(rule_host || rule_path)) as rule,
         max_by(verdict, length(rule_host || rule_path)) as verdict
  from urls u left join rules r
    on (u.host = rule_host or ends_with(u.host, '.' || rule_host)) and starts_with(u.path, rule_path)
  group by all)
select page_id, host, path, rule, coalesce(verdict, case when exists (
         select 1 from bad where host = bad_host or ends_with(host, '.' || bad_host)) then 'block' else 'allow' end) as verdict
from best""")
def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the rules, and by the blocked hosts where none fits."""
    return urls.judge(table(spark, sf_dir, "pages"), list(urls.ALLOW), list(urls.BLOCK))


def held(column: str) -> Column:
    """As a string; null is one space."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage_kind() -> Column:
    return F.crc32(F.concat(held("conv_id"), F.lit(":"), held("turn"))) % 20


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of conversation and turn."""
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(held("text"), ".!?", ""))
            .otherwise(held("text")))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (rows.withColumn("kind", damage_kind()).where("kind != 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(held("role")).alias("role"),
                    text.alias("text"), F.explode(times).alias("copy")).drop("copy"))


DIALOGUE_SQL = """
with recursive
bytes as (
  select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda x, y:
           case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)) as crcs),
keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(
               coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint)),
             lambda x, y: xor(x >> 8, crcs[(xor(x, y) & 255) + 1])), 4294967295) % 20 as kind
  from conversations, bytes),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
         unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as copy
  from keyed),
numbered as (
  select conv_id, turn, role, text, strpos('sua', left(role, 1)) as initial,
         row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
         not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as ending
  from damaged),
faulty as (
  select *, not blank and row_number() over (partition by conv_id, role, text order by i) > 1 as duplicate,
         lag(initial) over (partition by conv_id order by i) as prior
  from numbered),
marked as (
  select *, not blank and not duplicate and ending not in ('.', '!', '?') as truncated from faulty),
inserts(q, q2, letters, cost) as (values (0, 0, '', 0), (0, 2, 'I', 2), (0, 3, 'II', 4), (1, 1, '', 0), (1, 2, 'I', 2),
  (1, 3, 'II', 4), (2, 2, '', 0), (2, 3, 'I', 2), (3, 3, '', 0), (3, 2, 'I', 2)),
moves(q, initial, letter, q2, cost) as (
  select q::integer, null::integer, 'D', q::integer, 3 from range(4) as t(q) union all
  values (0, null, 'R', 2, 2), (1, null, 'R', 2, 2), (2, null, 'R', 3, 2), (3, null, 'R', 2, 2),
    (0, 1, 'K', 1, 0), (0, 2, 'K', 2, 0), (1, 2, 'K', 2, 0), (3, 2, 'K', 2, 0), (2, 3, 'K', 3, 0)),
best as (
  select distinct conv_id, 0::bigint as i, 0::integer as q, '000000' as path from marked
  union all
  select b.conv_id, b.i + 1, m.q2, min(lpad((left(path, 6)::int + x.cost + m.cost
           + case when truncated and m.letter != 'D' then 1 else 0 end)::varchar, 6, '0') || substr(path, 7) || x.letters || m.letter)
  from best b join marked r on r.conv_id is not distinct from b.conv_id and r.i = b.i + 1
  join inserts x on x.q = b.q
  join moves m on m.q = x.q2 and (m.letter = 'D' or not (blank or duplicate) and (m.letter = 'R' or m.initial = r.initial))
  group by all),
sizes as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
         count(*) filter (i > 1 and not (prior = 1 and initial = 2 or prior = 2 and initial = 3 or prior = 3 and initial = 2)) as illegal,
         list(role order by i) as roles, list(text order by i) as texts
  from marked group by conv_id),
ended as (
  select s.conv_id, min(lpad((left(path, 6)::int + x.cost)::varchar, 6, '0') || substr(path, 7) || x.letters) as path
  from sizes s join best b on b.conv_id is not distinct from s.conv_id and b.i = s.n
  join inserts x on x.q = b.q and x.q2 in (0, 3) group by s.conv_id),
letters as (
  select s.*, left(path, 6)::bigint as cost, substr(path, 7) as audit,
         list_filter(list_transform(string_split(substr(path, 7), ''), lambda c, j: {'c': c,
           'i': length(translate(substr(path, 7, j), 'I', ''))}), lambda e: e.c != 'D') as edits
  from sizes s join ended e on e.conv_id is not distinct from s.conv_id),
lines as (
  select *, array_to_string(list_transform(edits, lambda e, k: case when e.c = 'K' then roles[e.i] else case when
           (k - case when edits[1].c = 'K' and left(roles[edits[1].i], 1) = 's' then 1 else 0 end) % 2 = 1
           then 'user' else 'assistant' end end || ':' || case when e.c = 'I' then '' else texts[e.i] end), chr(10)) as said
  from letters)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost,
       coalesce(audit, '') as audit, sha256(coalesce(said, '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join lines l on l.conv_id is not distinct from c.conv_id"""


@query("op11_dialogue_repair", DIALOGUE_SQL)
def op11_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and its digest for every conversation, after damage."""
    rows = table(spark, sf_dir, "conversations")
    found = dialogues.summary(dialogues.repair(damage(rows)))
    zero = F.lit(0).cast("long")
    lost = rows.groupBy("conv_id").agg(F.max(damage_kind()).alias("most")).where("most = 0")
    return found.unionByName(lost.select(
        "conv_id", *[zero.alias(c) for c in ("gaps", *dialogues.COUNTS, "cost")], F.lit("").alias("audit"),
        F.sha2(F.lit(""), 256).alias("repaired_sha256")))


@query("op12_simhash")
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they and the next one's are.

    For ids divisible by 50, ``n_near`` is the number of documents in the radius, itself included.
    """
    found = fingerprints.compare(table(spark, sf_dir, "documents"))
    asked = F.coalesce(F.col("doc_id") % 50 == 0, F.lit(False))
    near = fingerprints.within(found.where(asked), found)
    rows = found.where(asked).join(near, ["high", "low"]).unionByName(
        found.where(~asked).withColumn("n_near", F.lit(None).cast("long")))
    # a row for each copy of a repeated row, in runs
    run = 1 << 16
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / run)))
    each = F.explode(F.array_repeat(F.lit(True), F.least(F.lit(run), F.col("copies") - F.col("run") * run).cast("int")))
    return (rows.withColumn("run", runs).withColumn("copy", each).select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.shown("high", "low").alias("fingerprint"),
        fingerprints.shown("edited_high", "edited_low").alias("edited_fingerprint"),
        fingerprints.likeness("high", "low", "edited_high", "edited_low").alias("near_edited"),
        fingerprints.likeness("high", "low", "next_high", "next_low").alias("near_next"), "n_near"))


DIVERGENCE_SQL = """
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body from documents),
words as (
  select r, lang, source, unnest(regexp_extract_all(body, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from docs),
kept as (select lang, term, count(*) as n from words group by all having count(distinct r) >= 3),
langs as (select lang, count(*)::hugeint as v, sum(n)::hugeint as total from kept group by lang),
counts as (select lang, source, term, count(*)::hugeint as c from words join kept using (lang, term) group by all),
totals as (
  select g.lang, g.source, coalesce(l.v, 0) as v, coalesce(sum(c.c), 0)::hugeint as n
  from (select distinct lang, source from docs) g left join langs l using (lang)
  left join counts c on c.lang = g.lang and c.source = g.source group by all),
shares as (
  select t.lang, t.source, k.term, coalesce(c.c, 0) as c, 1 + (1000000000 * (coalesce(c.c, 0) + 1)) // (t.n + t.v) as p,
         1 + (1000000000 * (k.n + 1)::hugeint) // (l.total + l.v) as q
  from totals t join kept k using (lang) join langs l using (lang)
  left join counts c on c.lang = t.lang and c.source = t.source and c.term = k.term),
priced as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source != b.source group by all),
found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
  from totals a join totals b on a.lang = b.lang and a.source != b.source
  left join priced p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', term, (((p - q) * (p - q)) // q)::bigint from shares where c > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from found)
select * from ranked where part = 'pair' or rank <= 200"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs of each source against the others of its language, and each source's dearest terms."""
    audit = divergence.Audit(table(spark, sf_dir, "documents"))
    return divergence.ranked(audit.pairs(), "pair").unionByName(
        divergence.ranked(audit.telling(), "term", divergence.MOST_TERMS))
