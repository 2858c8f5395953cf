"""K: rubric, section checks, redaction, provenance coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from venturelens.functions import text as tx
from venturelens.operators import evaluation as ops
from workload.common import query, table, text_table

SCORES = """
s_ as (select l.doc_id as company, m as method, cast(case when m = 'RAG' then quality * 3 else doc_id % 5 end as bigint) as factual, cast(toxic + 1 as bigint) as schema,
  cast(doc_id % 3 as bigint) as provenance, cast(2 as bigint) as hallucination, cast(quality as bigint) as readability from labels l, (values ('RAG'), ('Structured')) v(m)),
t_ as (select *, factual + schema + provenance + hallucination + readability as total, factual between 0 and 3 and schema between 0 and 2 and provenance between 0 and 2
  and hallucination between 0 and 2 and readability between 0 and 1 as in_range from s_)
"""


def scores(spark, sf):
    l = table(spark, sf, "labels").withColumn("method", F.explode(F.array(F.lit("RAG"), F.lit("Structured"))))
    k = F.col("doc_id")
    rows = l.select(
        k.alias("company"),
        "method",
        F.when(F.col("method") == "RAG", F.col("quality") * 3).otherwise(k % 5).cast("bigint").alias("factual"),
        (F.col("toxic") + 1).cast("bigint").alias("schema"),
        (k % 3).cast("bigint").alias("provenance"),
        F.lit(2).cast("bigint").alias("hallucination"),
        F.col("quality").cast("bigint").alias("readability"),
    )
    return ops.rubric_total(rows)


@query("k01_rubric_total", f"with {SCORES} select * from t_")
def k01(spark, sf):
    return scores(spark, sf)


@query(
    "k02_compare_methods",
    f"""with {SCORES} select company, cast(sum(total) filter (where method = 'RAG') as bigint) as "RAG", cast(sum(total) filter (where method = 'Structured') as bigint) as "Structured" from t_ group by company""",
)
def k02(spark, sf):
    return ops.compare_methods(scores(spark, sf))


@query(
    "k02_method_averages",
    f"""with {SCORES} select method, cast(count(*) as bigint) as n, round(avg(factual), 6) as avg_factual, round(avg(schema), 6) as avg_schema, round(avg(provenance), 6) as avg_provenance,
    round(avg(hallucination), 6) as avg_hallucination, round(avg(readability), 6) as avg_readability, round(avg(total), 6) as avg_total from t_ group by method""",
)
def k02_avg(spark, sf):
    rows = ops.method_averages(scores(spark, sf))
    return rows.select("method", "n", *[F.round(c, 6).alias(c) for c in rows.columns if c.startswith("avg_")])


SECTIONS = ["the", "und", " de ", "para"]


@query(
    "k03_missing_sections",
    "select doc_id, array_to_string(list_filter([" + ", ".join(f"'{s}'" for s in SECTIONS) + "], lambda s: not contains(text, s)), '|') as missing from documents",
)
def k03(spark, sf):
    rows = ops.section_report(table(spark, sf, "documents"), "text", SECTIONS)
    return rows.select("doc_id", F.array_join("missing_sections", "|").alias("missing"))


@query(
    "k04_section_order",
    """with p as (select doc_id, instr(text, 'th') as a, instr(text, 'in') as b, instr(text, 'on') as c from documents)
    select doc_id, a > 0 and b > a and c > b as in_order, c > 0 and c = greatest(a, b, c) as ends_with_last from p""",
)
def k04(spark, sf):
    rows = ops.section_report(table(spark, sf, "documents"), "text", ["th", "in", "on"])
    return rows.select("doc_id", "in_order", "ends_with_last")


@query(
    "k05_redact",
    f"""with m as (select doc_id, cast(len(regexp_extract_all(text, '{tx.EMAIL}')) as bigint) as n_emails, regexp_replace(text, '{tx.EMAIL}', '[email removed]', 'g') as t from documents)
    select doc_id, n_emails, cast(len(regexp_extract_all(t, '{tx.PHONE}')) as bigint) as n_phones, regexp_replace(t, '{tx.PHONE}', '[phone removed]', 'g') as text from m""",
)
def k05(spark, sf):
    return ops.redact(text_table(spark, sf, "documents", "doc_id")).select("doc_id", "n_emails", "n_phones", "text")


@query(
    "k06_provenance_coverage",
    """select 'events' as entity, cast(count(*) as bigint) as records, round(avg(case when value > 10 then 1 else 0 end), 6) as covered from events
    union all select 'products', count(*), round(avg(case when p_size > 20 then 1 else 0 end), 6) from part""",
)
def k06(spark, sf):
    def sourced(df, test):
        source = F.struct(F.lit("https://a.test").alias("source_url"))
        return df.select(F.when(test, F.array(source)).otherwise(F.array().cast("array<struct<source_url:string>>")).alias("provenance"))

    rows = ops.provenance_coverage(
        {
            "events": sourced(table(spark, sf, "events"), F.col("value") > 10),
            "products": sourced(table(spark, sf, "part"), F.col("p_size") > 20),
        }
    )
    return rows.withColumn("covered", F.round("covered", 6))
