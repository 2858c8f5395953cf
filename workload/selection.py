"""E: text selection and contexts."""

from __future__ import annotations

from pyspark.sql import functions as F

from venturelens import vocabulary as V
from venturelens.functions import text as tx
from venturelens.operators import records, selection
from workload.common import PAGES_CTE, WORDS, company_pages, query, sql_cut, sql_sentences, table, text_table


def _or_cut(sel: str, n: int) -> str:
    return f"(case when {sel} <> '' then {sel} else {sql_cut('text', n)} end)"


def _label(label: str, sel: str) -> str:
    return f"(case when {sel} <> '' then '{label}' || {sel} end)"


_S = {k: (lambda n, k=k: sql_sentences("text", WORDS[k], n)) for k in WORDS}
RULES_SQL = {
    "homepage": sql_cut("text", 2500),
    "about": "concat_ws(chr(10) || chr(10), " + sql_cut("text", 3500) + ", " + _label("Locations: ", _S["location"](5)) + ", " + _label("Leadership: ", _S["leadership"](10)) + ")",
    "blog": _or_cut(_S["funding"](8), 2000),
    "press": _or_cut(_S["funding"](10), 2000),
    "careers": "(case when coalesce(nullif(concat_ws(chr(10) || chr(10), " + _label("Headcount info: ", _S["headcount"](5)) + ", " + _label("Locations: ", _S["location"](5)) + "), ''), '') <> '' then concat_ws(chr(10) || chr(10), " + _label("Headcount info: ", _S["headcount"](5)) + ", " + _label("Locations: ", _S["location"](5)) + ") else " + sql_cut("text", 1500) + " end)",
    "product": _or_cut(_S["product"](15), 4000),
    "pricing": sql_cut("text", 4000),
    "customers": _or_cut(_S["customer"](10), 2000),
    "partners": sql_cut("text", 2000),
    "team": _or_cut(_S["leadership"](20), 4000),
}
SELECTED_CTE = (
    PAGES_CTE
    + ", selected_ as (select * from (select *, case page_type "
    + " ".join(f"when '{k}' then {v}" for k, v in RULES_SQL.items())
    + f" else {sql_cut('text', 2000)} end as selected from pages_ where length(text) > 0) where length(selected) > 0)"
)


@query(
    "e01_keyword_sentences",
    f"select doc_id, {sql_sentences('text', ['the', 'und', 'para'], 10)} as selected from documents",
)
def e01(spark, sf):
    d = text_table(spark, sf, "documents", "doc_id")
    return d.select("doc_id", tx.keyword_sentences(F.col("text"), ["the", "und", "para"], 10).alias("selected"))


@query("e02_cut_at_sentence", f"select doc_id, {sql_cut('text', 500)} as cut from documents")
def e02(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.cut_at_sentence(F.col("text"), 500).alias("cut"))


def _rule(name, ident):
    @query(f"{ident}_{name}_rule", f"select doc_id, {RULES_SQL[name]} as selected from documents where length(text) > 0")
    def run(spark, sf):
        d = text_table(spark, sf, "documents", "doc_id").filter(F.length("text") > 0)
        return d.select("doc_id", tx.rule_text(name, F.col("text"), WORDS).alias("selected"))


_rule("homepage", "e03")
_rule("about", "e04")
_rule("blog", "e05")
_rule("press", "e06")
_rule("careers", "e07")
_rule("product", "e08")
_rule("pricing", "e09")
_rule("partners", "e09b")
_rule("customers", "e10")
_rule("team", "e11")


@query("e12_select_pages", f"with {SELECTED_CTE} select doc_id, company_id, page_type, selected from selected_")
def e12(spark, sf):
    return selection.select_pages(company_pages(spark, sf), WORDS).select("doc_id", "company_id", "page_type", "selected")


@query("e13_token_estimate", "select doc_id, cast(length(text) // 4 as bigint) as tokens from documents")
def e13(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.token_estimate(F.length("text")).alias("tokens"))


@query(
    "e14_reduction_stats",
    f"""with {SELECTED_CTE}, s as (
      select source, cast(sum(length(text)) as bigint) as original_chars, cast(sum(length(selected)) as bigint) as filtered_chars
      from selected_ group by source)
    select *, round((1.0 - cast(filtered_chars as double) / original_chars) * 100, 6) as reduction_pct,
           cast(original_chars // 4 as bigint) as original_tokens_est, cast(filtered_chars // 4 as bigint) as filtered_tokens_est
    from s""",
)
def e14(spark, sf):
    stats = selection.reduction_stats(selection.select_pages(company_pages(spark, sf), WORDS), key="source")
    return stats.withColumn("reduction_pct", F.round("reduction_pct", 6))


SEED_FROM_NATIONS = """
seed_ as (
  select 'n' || n_nationkey as company_id, n_name as company_name, 'ships by ' || r_name as description,
         r_name as hq_city, n_name as hq_country, 1990 + n_nationkey as founded_year
  from nation join region on n_regionkey = r_regionkey)
"""


def nation_seed(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.concat(F.lit("n"), "n_nationkey").alias("company_id"),
        F.col("n_name").alias("company_name"),
        F.lit(None).cast("string").alias("legal_name"),
        F.concat(F.lit("ships by "), "r_name").alias("description"),
        F.lit(None).cast("string").alias("funding"),
        (F.lit(1990) + F.col("n_nationkey")).alias("founded_year"),
        F.col("r_name").alias("hq_city"),
        F.col("n_name").alias("hq_country"),
        F.lit(None).cast("string").alias("forbes_url"),
        F.array("r_name", F.lit("Trade")).alias("categories"),
        F.lit(None).cast("string").alias("website"),
        F.lit(None).cast("string").alias("linkedin"),
    )


@query(
    "e15_seed_pages",
    f"""with {SEED_FROM_NATIONS}
    select company_id, 'seed' as page_type, '' as source_url,
      chr(10) || 'OFFICIAL SOURCE - company list:' || chr(10) || 'Company: ' || company_name || chr(10)
      || 'Legal Name: ' || company_name || chr(10) || 'Description: ' || description || chr(10) || 'Funding: ' || chr(10)
      || 'Founded: ' || founded_year || chr(10) || 'HQ: ' || hq_city || ', ' || hq_country || chr(10)
      || 'Categories: ' || hq_city || ', Trade' || chr(10) || 'Website: ' || chr(10) || 'LinkedIn: ' || chr(10) as text
    from seed_""",
)
def e15(spark, sf):
    return selection.seed_pages(nation_seed(spark, sf))


_HEADS = "case page_type " + " ".join(f"when '{k}' then '=== {k.upper()} PAGE ==='" for k in V.CONTEXT_ORDER) + " end"
_ORDER = "case page_type " + " ".join(f"when '{k}' then {i}" for i, k in enumerate(V.CONTEXT_ORDER)) + " end"
CONTEXT_CTE = (
    SELECTED_CTE
    + f""", context_ as (select company_id, string_agg({_HEADS} || chr(10) || chr(10) || selected || chr(10) || chr(10), chr(10)
      order by {_ORDER}) as whole from selected_ where page_type <> 'other' group by company_id)"""
)


@query("e16_context_pack", f"with {CONTEXT_CTE} select company_id, whole as context from context_")
def e16(spark, sf):
    return selection.context_pack(selection.select_pages(company_pages(spark, sf), WORDS), cap=None)


@query("e17_context_cap", f"with {CONTEXT_CTE} select company_id, substring(whole, 1, 9000) as context from context_")
def e17(spark, sf):
    return selection.context_pack(selection.select_pages(company_pages(spark, sf), WORDS), cap=9000)


@query(
    "h06_model_requests",
    f"""with {CONTEXT_CTE}, passes(pass_name, system_prompt, max_tokens) as (values
      {", ".join(f"('{n}', '" + p.replace("'", "''") + f"', {m})" for n, p, m in records.PASSES)})
    select company_id, substring(whole, 1, 30000) as user_content, pass_name, system_prompt, cast(max_tokens as int) as max_tokens,
      cast(0.1 as double) as temperature from context_, passes""",
)
def h06(spark, sf):
    contexts = selection.context_pack(selection.select_pages(company_pages(spark, sf), WORDS))
    return records.model_requests(contexts)
