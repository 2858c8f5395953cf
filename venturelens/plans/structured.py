"""Structured path: pages to selected text, contexts, signals, payloads and dashboards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from venturelens.operators import dashboard, pages, records, selection, signals
from venturelens.operators.skew import union_rows


def contexts_from_html(raw: DataFrame, seed_rows: DataFrame | None = None, min_text: int = 500, words: dict | None = None) -> DataFrame:
    """Raw pages to one capped context per company: extract, gate, select, pack (one shuffle)."""
    texts = pages.text_gate(pages.parse_text(raw), min_text).select("company_id", "page_type", "source_url", "text")
    if seed_rows is not None:
        texts = union_rows([texts, selection.seed_pages(seed_rows)])
    return selection.context_pack(selection.select_pages(texts, words))


def requests_from_pages(texts: DataFrame) -> DataFrame:
    """Model requests of every company and pass."""
    return records.model_requests(selection.context_pack(selection.select_pages(texts)))


def dashboards_from_tables(
    company: DataFrame, children: Mapping[str, DataFrame], generated_at: str, newest: bool = True
) -> DataFrame:
    """Typed tables to Markdown, by aggregates per section."""
    return dashboard.dashboards(company, children, generated_at, newest=newest)


def snapshots_from_pages(texts: DataFrame, **rules) -> DataFrame:
    """Hiring snapshots with their provenance; ``rules`` are those of ``signals.hiring_snapshots``."""
    return signals.snapshot_provenance(signals.hiring_snapshots(texts, **rules), texts)


def visibility_from_pages(texts: DataFrame, repo_answers: DataFrame, contributor_answers: DataFrame) -> DataFrame:
    """Repository URLs in page text, looked up in the API answer tables: one visibility row per company."""
    metrics = signals.with_contributors(signals.repo_metrics(repo_answers), contributor_answers)
    candidates = signals.repo_candidates(signals.repo_urls(texts))
    return signals.visibility_rows(signals.first_found_repo(candidates, metrics))
