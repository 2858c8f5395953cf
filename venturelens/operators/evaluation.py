"""Rubric scores, section checks, contact redaction and provenance coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venturelens import vocabulary as V
from venturelens.functions import markdown as md
from venturelens.functions import text as tx
from venturelens.operators.skew import union_rows


def rubric_total(scores: DataFrame, limits: Mapping[str, int] = V.RUBRIC) -> DataFrame:
    """``total`` of the scores and ``in_range``, whether each lies within its limit."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in limits])
    fits = reduce(lambda a, b: a & b, [F.col(c).between(0, top) for c, top in limits.items()])
    return scores.withColumn("total", total.cast("bigint")).withColumn("in_range", fits)


def compare_methods(scores: DataFrame, key: str = "company", methods: Sequence[str] = ("RAG", "Structured")) -> DataFrame:
    """Total per company and method as columns."""
    return scores.groupBy(key).pivot("method", list(methods)).agg(F.sum("total"))


def method_averages(scores: DataFrame, limits: Mapping[str, int] = V.RUBRIC) -> DataFrame:
    return scores.groupBy("method").agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"avg_{c}") for c in [*limits, "total"]]
    )


def section_report(dashboards: DataFrame, text: str = "dashboard", sections: Sequence[str] = V.SECTIONS) -> DataFrame:
    """Missing sections, whether all stand in order, and whether the last section is the final one."""
    body = F.col(text)
    return dashboards.withColumn("missing_sections", md.missing_sections(body, sections)).withColumn(
        "in_order", md.sections_in_order(body, sections)
    ).withColumn("ends_with_last", _last_is_final(body, sections))


def _last_is_final(body: Column, sections: Sequence[str]) -> Column:
    at = [F.instr(body, s) for s in sections]
    if len(at) == 1:
        return at[0] > 0
    return (at[-1] > 0) & (at[-1] == F.greatest(*at))


def redact(df: DataFrame, text: str = "text", email: str = tx.EMAIL, phone: str = tx.PHONE) -> DataFrame:
    """E-mail addresses and phone numbers replaced, with the number of each.

    The mail pattern runs only on texts with an ``@`` in them.
    """
    body = F.col(text)
    may_have = F.contains(body, F.lit("@"))
    no_mail = F.when(may_have, F.regexp_replace(body, email, "[email removed]")).otherwise(body)
    return (
        df.withColumn("n_emails", F.when(may_have, F.regexp_count(body, F.lit(email))).otherwise(0).cast("bigint"))
        .withColumn(text, no_mail)
        .withColumn("n_phones", F.regexp_count(body, F.lit(phone)).cast("bigint"))
        .withColumn(text, F.regexp_replace(body, phone, "[phone removed]"))
    )


def provenance_coverage(entities: Mapping[str, DataFrame]) -> DataFrame:
    """Share of records with at least one source, per entity."""
    rows = union_rows(
        [
            df.select(F.lit(name).alias("entity"), (F.size("provenance") > 0).alias("_ok"))
            for name, df in entities.items()
        ]
    )
    return rows.groupBy("entity").agg(
        F.count(F.lit(1)).alias("records"), F.avg(F.col("_ok").cast("int")).alias("covered")
    )
