"""Run reports and incremental refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venturelens.operators.skew import keyed_join, top_per_group, union_rows


def run_counts(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total, successful and failed items, over all or per ``by`` columns."""
    aggs = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    ]
    return results.groupBy(*by).agg(*aggs) if by else results.agg(*aggs)


def daily_report(results: DataFrame, updated: DataFrame, date: str = "date") -> DataFrame:
    """One row per run date: refreshed, failed and updated counts (names: ``failed_items``)."""
    counts = results.groupBy(date).agg(
        F.count_if(F.col("status") == "success").alias("companies_refreshed"),
        F.count_if(F.col("status") == "failed").alias("companies_failed"),
    )
    made = updated.groupBy(date).agg(F.count(F.lit(1)).alias("_u"))
    return counts.join(made, date, "left").select(
        F.lit("Daily Refresh").alias("report"),
        date,
        "companies_refreshed",
        "companies_failed",
        F.coalesce("_u", F.lit(0).cast("bigint")).alias("vector_db_updated"),
        F.lit("completed").alias("status"),
    )


def failed_items(results: DataFrame, by: Sequence[str] = ("date",), item: str = "company") -> DataFrame:
    """The names behind a report's failed count, one row each, so a bad run cannot outgrow a row."""
    return results.filter(F.col("status") == "failed").select(*by, item).distinct()


def full_report(results: DataFrame, indexed: DataFrame) -> DataFrame:
    """The full-load report row."""
    rows = union_rows([results.select("status"), indexed.select(F.lit("indexed").alias("status"))])
    return rows.agg(
        F.lit("Full Ingestion").alias("report"),
        F.count_if(F.col("status") != "indexed").alias("total_companies"),
        F.count_if(F.col("status") == "success").alias("scraped_successfully"),
        F.count_if(F.col("status") == "failed").alias("scrape_failures"),
        F.count_if(F.col("status") == "indexed").alias("indexed_to_vector_db"),
        F.lit("completed").alias("run_status"),
    )


def batch_summary(stats: DataFrame, ok: str = "success") -> DataFrame:
    """Items, successes and all others, as the batch jobs print at their end."""
    return stats.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == ok).alias("successful"),
        F.count_if(F.col("status") != ok).alias("failed"),
    )


def successful_only(rows: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Rows of companies with at least one successful result."""
    ok = results.filter(F.col("status") == "success").select(key).distinct()
    return keyed_join(rows, ok, [key], "left_semi")


def with_hash(pages: DataFrame, text: str = "text") -> DataFrame:
    return pages.withColumn("text_hash", F.sha2(F.col(text), 256))


def changed_pages(pages: DataFrame, indexed: DataFrame, keys: Sequence[str] = ("company_id", "page_type")) -> DataFrame:
    """Pages whose (key, text hash) is not in the index yet.

    Only keys and hashes of the index are read. Both sides shuffle on them, and many copies of one
    page are split by the adaptive skew join (an anti-join splits its left side).
    """
    seen = indexed.select(*keys, "text_hash")
    return with_hash(pages).join(seen, [*keys, "text_hash"], "left_anti")


def first_of_copies(rows: DataFrame, keys: Sequence[str], order: str, salts: int = 16) -> DataFrame:
    """One row per key, the first in ``order``. Two rounds, so that a page with many copies is thinned out before it meets in one task."""
    return top_per_group(rows, keys, [F.col(order).asc_nulls_first()], 1, [order], "_first", salts).drop("_first")


def latest_per_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The newest row per key as an aggregate with map-side combine."""
    rest = [c for c in rows.columns if c != key]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_b"))
    return best.select(key, "_b.*")


def guarded(value: Column, reason: str) -> Column:
    """struct(value, error): a failing item becomes a status, not an exception."""
    return F.struct(
        value.alias("value"), F.when(value.isNull(), F.lit(reason)).alias("error")
    )


def indexed_companies(results: DataFrame, pages: DataFrame, key: str = "company") -> DataFrame:
    """Successful companies that have pages of the run, each once."""
    ok = results.filter(F.col("status") == "success").select(key).distinct()
    return ok.join(pages.select(key).distinct(), key, "left_semi")
