"""Text selection per page, reduction statistics and the per-company context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venturelens import vocabulary as V
from venturelens.functions import text as tx


def select_pages(pages: DataFrame, words: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Adds ``selected``, the text kept by the page type's rule; pages without text are dropped."""
    selected = tx.selected_text(F.col("page_type"), F.col("text"), words)
    # One generated row or none: a filter on the new column would evaluate the rules twice.
    kept = F.filter(F.array(selected), lambda s: F.length(s) > 0)
    return pages.filter(F.length("text") > 0).select("*", F.explode(kept).alias("selected"))


def reduction_stats(pages: DataFrame, key: str = "company_id") -> DataFrame:
    """Characters and token estimates before and after selection, per company."""
    before, after = F.col("original_chars"), F.col("filtered_chars")
    return (
        pages.groupBy(key)
        .agg(
            F.sum(F.length("text")).alias("original_chars"),
            F.sum(F.length("selected")).alias("filtered_chars"),
        )
        .withColumn(
            "reduction_pct",
            F.when(before > 0, (F.lit(1.0) - after / before) * 100).otherwise(F.lit(0.0)),
        )
        .withColumn("original_tokens_est", tx.token_estimate(before))
        .withColumn("filtered_tokens_est", tx.token_estimate(after))
    )


def seed_block(source_label: str = "company list") -> Column:
    """A seed row as a labelled text block (missing values are empty)."""

    def value(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    name = value("company_name")
    lines = [
        F.lit(f"\nOFFICIAL SOURCE - {source_label}:"),
        F.concat(F.lit("Company: "), name),
        F.concat(F.lit("Legal Name: "), F.coalesce(F.col("legal_name"), name)),
        F.concat(F.lit("Description: "), value("description")),
        F.concat(F.lit("Funding: "), value("funding")),
        F.concat(F.lit("Founded: "), value("founded_year")),
        F.concat(F.lit("HQ: "), value("hq_city"), F.lit(", "), value("hq_country")),
        F.concat(
            F.lit("Categories: "),
            F.array_join(F.coalesce(F.col("categories"), F.array().cast("array<string>")), ", "),
        ),
        F.concat(F.lit("Website: "), value("website")),
        F.concat(F.lit("LinkedIn: "), value("linkedin"), F.lit("\n")),
    ]
    return F.concat_ws("\n", *lines)


def seed_pages(seed: DataFrame, source_label: str = "company list") -> DataFrame:
    """Seed rows in the page layout, to be united with the crawled pages."""
    return seed.select(
        "company_id",
        F.lit(V.SEED_PAGE_TYPE).alias("page_type"),
        F.coalesce(F.col("forbes_url"), F.lit("")).alias("source_url"),
        seed_block(source_label).alias("text"),
    )


def context_blocks(source_label: str = "company list") -> dict[str, str]:
    """Page type to its heading, in reading order, the seed block first."""
    heads = {V.SEED_PAGE_TYPE: f"=== OFFICIAL SOURCE: {source_label} ==="}
    heads.update({kind: f"=== {kind.upper()} PAGE ===" for kind in V.CONTEXT_ORDER})
    return heads


def context_pack(
    selected: DataFrame,
    key: str = "company_id",
    tie: str = "source_url",
    source_label: str = "company list",
    cap: int | None = V.CONTEXT_CAP,
) -> DataFrame:
    """One context text per company: a headed block per page type, cut at ``cap`` characters.

    One shuffle. Each type is a ``min_by`` aggregate (lowest ``tie`` wins, a missing one counts as empty), so map tasks send at
    most one block per company and type however many pages a company has.
    """
    columns, names = [], []
    for kind, head in context_blocks(source_label).items():
        is_kind = F.col("page_type") == kind
        block = F.concat(F.lit(head + "\n\n"), F.col("selected"), F.lit("\n\n"))
        name = f"_{kind}"
        names.append(name)
        order = F.struct(F.coalesce(F.col(tie), F.lit("")), F.xxhash64("selected"))
        columns.append(F.min_by(F.when(is_kind, block), F.when(is_kind, order)).alias(name))
    wanted = selected.filter(F.col("page_type").isin(list(context_blocks(source_label))))
    joined = F.concat_ws("\n", *names)
    return wanted.groupBy(key).agg(*columns).select(
        key, (F.substring(joined, 1, cap) if cap else joined).alias("context")
    )
