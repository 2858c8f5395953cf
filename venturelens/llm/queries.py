"""Registered queries of the operators in this folder: name -> (Spark function, SQL twin or None)."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venturelens.llm import bpe, decontaminate, imatch, jaccard, langid, orc_tokens, periodic_runs, quality, resampling, sparse_suffix, token_counts, toxicity, warc
from venturelens.llm.common import crc32_mod, table
from venturelens.session import scratch_path

LLM_REGISTRY: dict = {}


def query(name: str, sql: str | None = None):
    def add(run):
        LLM_REGISTRY[name] = (run, sql)
        return run

    return add


_RULES = ["short", "repeats", "symbols", "dup_lines", "word_length"]
# A rule's rate over all documents, the variance between hosts beyond chance, and from them the prior's strength, as in quality.host_rates.
_PRIORS = ", ".join(
    f"""m_{r} as mean_{r}, least(greatest(case when v_{r} - m_{r} * (1 - m_{r}) * inverse > 0
      then m_{r} * (1 - m_{r}) / (v_{r} - m_{r} * (1 - m_{r}) * inverse) - 1 else 1000.0 end, 2.0), 1000.0) as weight_{r}"""
    for r in _RULES
)
_RATES = {r: f"((k_{r} + mean_{r} * weight_{r}) / (n_docs + weight_{r}))" for r in _RULES}


@query(
    "op1_host_quality",
    rf"""
with words as (select doc_id, source as host, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
grams as (
  select doc_id, i, md5(array_to_string(ws[i + 1:i + 3], ' ')) as g from (select doc_id, ws, unnest(range(len(ws) - 2)) as i from words where len(ws) > 3)
),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from grams) where c > 1),
repeats as (select doc_id, count(distinct i + k) as n from again, (values (0), (1), (2)) as t(k) group by doc_id),
lines as (select doc_id, unnest(string_split(text, chr(10))) as line from words),
dups as (select doc_id, count(*) - count(distinct line) as n from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
measures as (
  select doc_id, host, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
         length(regexp_replace(array_to_string(ws, ''), '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(d.n, 0)::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words
  from words left join dups d using (doc_id) left join repeats r using (doc_id)
),
fails as (
  select *, (n_words < 50)::int as f_short, (100 * n_repeat_words > 50 * n_words)::int as f_repeats, (n_symbols > 0.1::double * n_words)::int as f_symbols,
         (n_dup_lines >= 3)::int as f_dup_lines, (n_words > 0 and (word_chars < 2.0 * n_words or word_chars > 12.0 * n_words))::int as f_word_length from measures
),
hosts as (select host, count(*) as n_docs, {", ".join(f"sum(f_{r}) as k_{r}" for r in _RULES)} from fails where host is not null group by host),
moments as (select avg(1.0::double / n_docs) as inverse, {", ".join(f"sum(k_{r})::double / sum(n_docs) as m_{r}, var_pop(k_{r}::double / n_docs) as v_{r}" for r in _RULES)} from hosts),
priors as (select {_PRIORS} from moments),
verdicts as (select host, {" or ".join(f"{x} > 0.5" for x in _RATES.values())} as bad, {", ".join(f"({x} > 0.01)::int as habit_{r}" for r, x in _RATES.items())} from hosts, priors)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f_short + f_repeats > 0 as base_failed,
       concat_ws(',', {", ".join(f"case when f_{r} = 1 then '{r}' end" for r in _RULES)}) as failed_rules, coalesce(bad, false) as host_rejected,
       f_short + f_repeats = 0 and not coalesce(bad, false) and {" + ".join(f"f_{r} * coalesce(habit_{r}, 0)" for r in _RULES)} = 0 as kept
from fails left join verdicts using (host)""",
)
def op1_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.host_quality(docs, store=scratch_path(spark, "op1"))
    return found.withColumn("failed_rules", F.array_join("failed_rules", ","))


@query("op4_orc_tokens")
def op4_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "op4")
    orc_tokens.write_orc(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path, end=2)
    return orc_tokens.document_index(spark, path)


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.train(docs))
    return found.select("doc_id", (crc32_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@query(
    "op6_ngram_jaccard",
    r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents
),
sets as (
  select distinct doc_id, array_to_string(ws[i + 1:i + least(4, len(ws))], ' ') as shingle
  from (select doc_id, ws, unnest(range(len(ws) - least(4, len(ws)) + 1)) as i from words where len(ws) > 0)
),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from sets a join sets b on a.shingle = b.shingle and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)),
ways as (select a, b from links union all select b, a from links),
reach as (select a, b from ways union select r.a, l.b from reach r join ways l on r.b = l.a),
least_ as (select a as doc_id, min(b) as c from reach group by a)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, least(d.doc_id, c)::bigint as component_id
from documents d left join sizes using (doc_id) left join least_ using (doc_id)""",
)
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return jaccard.near_duplicates(docs, size=4, numerator=85, denominator=100)


@query(
    "op7_sparse_suffix",
    r"""
with words as (select doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws from documents where text is not null),
classes as (select text, min(doc_id) as doc_id, count(*) as copies from words group by text),
windows as (
  select doc_id, i, md5(array_to_string(ws[i + 1:i + 50], ' ')) as w
  from (select doc_id, ws, unnest(range(len(ws) - 49)) as i from words semi join classes using (doc_id) where len(ws) >= 50)
),
placed as (select *, row_number() over (partition by w order by doc_id, i) as place, count(*) over (partition by w) as places from windows),
hits as (
  select doc_id, i as s, i + 50 as e, place = 1 as original from placed where places > 1
  union all
  select x.doc_id, 0, len(ws), x.doc_id = c.doc_id from words x join classes c using (text) where copies > 1 and len(ws) >= 50
),
marked as (select *, s > max(e) over (partition by doc_id, original order by s, e rows between unbounded preceding and 1 preceding) as apart from hits),
numbered as (select *, sum(coalesce(apart, false)::int) over (partition by doc_id, original order by s, e rows unbounded preceding) as span from marked),
spans as (select doc_id, original, min(s) as s, max(e) as e from numbered group by doc_id, original, span)
select doc_id, count(*)::bigint as n_spans, count(*) filter (where not original)::bigint as n_repeats,
       coalesce(sum(e - s) filter (where not original), 0)::bigint as repeated_words,
       string_agg(s || '-' || e || case when original then '*' else '' end, ',' order by s, e, original) as spans
from spans group by doc_id""",
)
def op7_sparse_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document with a repeated passage; ``spans`` are word ranges, those to keep with an asterisk."""
    found = sparse_suffix.repeated_passages(table(spark, sf_dir, "documents"))
    repeats = F.filter("spans", lambda s: ~s["original"])
    shown = F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"), F.when(s["original"], F.lit("*")).otherwise(F.lit(""))))
    return found.select(
        "doc_id",
        F.size("spans").cast("long").alias("n_spans"),
        F.size(repeats).cast("long").alias("n_repeats"),
        F.aggregate(repeats, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("repeated_words"),
        F.array_join(shown, ",").alias("spans"),
    )


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_documents(docs, toxicity.train(docs, labels))
    return scored.select(
        "doc_id",
        (crc32_mod("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"),
    )


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))


@query(
    "op2_warc_revisits",
    """
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
h as (select page_id, octet_length(b) as n, sha256(b) as d from p),
o as (select n, d, min(page_id) as first from h where n >= 100 group by n, d)
select h.page_id, cast(h.n as bigint) as payload_bytes, h.d as payload_digest,
       case when o.first < h.page_id then 'revisit' else 'response' end as record_type,
       case when o.first < h.page_id then o.first end as refers_to
from h left join o on h.n = o.n and h.d = o.d""",
)
def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, deduplicated = scratch_path(spark, "op2-raw"), scratch_path(spark, "op2-dedup")
    warc.write_pages(table(spark, sf_dir, "pages"), raw, date="2024-01-01T00:00:00Z")
    warc.deduplicate(spark, raw, deduplicated, date="2024-01-02T00:00:00Z")
    read = warc.read(spark, deduplicated, payload=False)
    response = F.col("record_type") == "response"  # its digest is that of the payload read back; a revisit has the header's
    return read.select(
        "page_id",
        "payload_bytes",
        F.when(response, F.col("digest_read")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    both = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op10_decontaminate",
    r"""
with docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents
),
items as (
  select coalesce(item_id::varchar, '') as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark
),
windows as (
  select item, j, d, array_to_string(ws[j + 1:j + d], ' ') as w
  from (select item, ws, least(10, len(ws)) as d, unnest(range(len(ws) - least(10, len(ws)) + 1)) as j from items where len(ws) > 0)
),
depths as (select distinct d from windows),
places as (
  select doc_id, p, d, array_to_string(ws[p + 1:p + d], ' ') as w
  from (select doc_id, ws, d, unnest(range(len(ws) - d + 1)) as p from docs, depths where len(ws) >= d)
),
hits as (select doc_id, item, p, j, d from places join windows using (d, w)),
covered as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(p, p + d)) as i from hits) group by doc_id),
runs as (select *, p - row_number() over (partition by doc_id, item, p - j order by p) as run from (select distinct doc_id, item, p, j, d from hits)),
matches as (select doc_id, item, max(p + d) - min(p) as n from runs group by doc_id, item, p - j, run),
longest as (select doc_id, first(item order by n desc, item) as longest_item, max(n) as longest_words from matches group by doc_id),
named as (select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as sha from (select distinct doc_id, item from hits) group by doc_id)
select docs.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, coalesce(sha, sha256('')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated, longest_item, longest_words::int as longest_words
from docs left join covered using (doc_id) left join named using (doc_id) left join longest using (doc_id)""",
)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        decontaminate.items_digest().alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.get("matches", F.lit(0))["item_id"].alias("longest_item"),
        F.get("matches", F.lit(0))["n_words"].alias("longest_words"),
    )


def repeated_end(doc_id: object, n: int) -> np.ndarray | None:
    """For one id in ten: the words from some place on repeat a stretch that begins there."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or doc_id is None:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=repeated_end)
    # Runs come by start and period, so the first of the greatest exponent stays.
    longer = lambda a, r: F.when(r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a)
    best = F.when(F.size("runs") > 0, F.aggregate("runs", F.get("runs", F.lit(0)), longer))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op12_imatch")
def op12_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


@query(
    "op13_importance_resampling",
    r"""
with recursive step(i, k, v) as (
  select i, 0, i from range(256) r(i)
  union all
  select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from step where k < 8
),
crc_table as (select list(v order by i) as l from step where k = 8),
texts as (
  select doc_id, text, true as source from documents union all select null, text, false from benchmark
),
words as (
  select doc_id, source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from texts
),
single as (select distinct unnest(ws) as w from words),
bytes as (select w, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::bigint) as b from single),
bucket as (
  select w, xor(list_reduce(list_prepend(4294967295::bigint, b), lambda c, x: xor(c >> 8, l[(xor(c, x) & 255) + 1])), 4294967295) % 10000 as k
  from bytes cross join crc_table
),
features as (select doc_id, source, unnest(ws) as w from words),
counts as (
  select k, count(*) filter (source) as s, count(*) filter (not source) as t from features join bucket using (w) group by k
),
totals as (select coalesce(sum(s), 0) as s, coalesce(sum(t), 0) as t from counts),
gains as (
  select k, floor(1000 * ln(((c.t + 1) * (a.s + 10000))::double / ((c.s + 1) * (a.t + 10000))::double))::bigint as g from counts c, totals a
),
weights as (
  select doc_id, count(*) as n, sum(g)::bigint as weight from features join bucket using (w) join gains using (k) where source group by doc_id
),
scores as (
  select d.doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
         coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::ubigint + 0.5::double) / 4294967296::double)))::bigint as score
  from documents d left join weights using (doc_id)
),
ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n from scores where n_features >= 20
)
select doc_id, n_features, weight, score, case when r <= 10 * n // 100 then r end as rank
from scores left join ranked using (doc_id)""",
)
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resample(docs, benchmark, seed=2024).select("doc_id", "n_features", "weight", "score", "rank")
