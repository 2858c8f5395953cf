"""Registration, table loading and SQL snippets shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venturelens import vocabulary as V
from venturelens.functions.text import SPACES
from venturelens.operators.skew import spread

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        REGISTRY[name] = (run, sql)
        return run

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text_table(spark: SparkSession, sf: str, name: str, key: str) -> DataFrame:
    """A table of wide text rows, spread over the cores where its files give fewer splits than cores."""
    return spread(table(spark, sf, name), key)


# The driver's prose holds none of the default keywords, so queries pass words that occur in it.
WORDS = {
    "funding": ["then", "with", "pour"],
    "headcount": ["que", "und"],
    "location": ["thin", "hein", "para"],
    "product": ["tion", "sch"],
    "customer": ["here", "dans"],
    "leadership": ["ther", "los"],
}
PAGE_KINDS = [*V.PAGE_TYPES, "other"]


def company_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as pages: eleven consecutive documents are one company, one page type each."""
    d = text_table(spark, sf, "documents", "doc_id")
    kinds = F.array(*[F.lit(k) for k in PAGE_KINDS])
    return d.select(
        F.concat(F.lit("c"), F.floor(F.col("doc_id") / 11).cast("string")).alias("company_id"),
        F.get(kinds, (F.col("doc_id") % 11).cast("int")).alias("page_type"),
        F.format_string("https://example.com/%019d", "doc_id").alias("source_url"),
        F.col("doc_id"),
        F.col("source"),
        F.col("text"),
    )


def sql_list(words: Sequence[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


PAGES_CTE = f"""
pages_ as (
  select 'c' || cast(doc_id // 11 as varchar) as company_id,
         {sql_list(PAGE_KINDS)}[cast(doc_id % 11 as int) + 1] as page_type,
         'https://example.com/' || lpad(cast(doc_id as varchar), 19, '0') as source_url,
         doc_id, source, text
  from documents)
"""


def sql_strip(x: str) -> str:
    return f"trim({x}, '{SPACES}')"


def sql_any(low: str, words: Sequence[str]) -> str:
    if not words:
        return "false"
    return "(" + " or ".join("contains(" + low + ", '" + w.replace("'", "''") + "')" for w in words) + ")"


def sql_sentences(text: str, words: Sequence[str], n: int) -> str:
    """DuckDB twin of functions.text.keyword_sentences."""
    kept = (
        f"list_filter(list_transform(list_filter(string_split_regex({text}, '[.!?]+'), "
        f"lambda s: {sql_any('lower(s)', [w.lower() for w in words])}), lambda s: {sql_strip('s')}), lambda s: s <> '')"
    )
    joined = f"array_to_string(({kept})[1:{n}], '. ')"
    return f"(case when {joined} = '' then '' else {joined} || '.' end)"


def sql_cut(text: str, n: int) -> str:
    """DuckDB twin of functions.text.cut_at_sentence."""
    head = f"substring({text}, 1, {n})"
    end = f"({n + 1} - instr(reverse({head}), '.'))"
    return (
        f"(case when length({text}) <= {n} then {text} when {end} > 1 and {end} <= {n} "
        f"then substring({head}, 1, {end}) else {head} || '...' end)"
    )
