"""Retrieval path: text files to a chunk store, query vectors to contexts and prompts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venturelens.functions.urls import stable_id
from venturelens.operators import retrieval as rt


def build_index(files: DataFrame, model: Callable) -> DataFrame:
    """Chunks with unit vectors and a repeatable key per chunk."""
    chunks = rt.chunk_rows(files)
    keyed = chunks.withColumn("chunk_key", stable_id(F.col("company"), F.col("source"), F.col("chunk_id"), F.col("content")))
    return rt.embed(keyed, model)


def retrieve(store: DataFrame, queries: DataFrame, k: int = 3, top_k: int = 15) -> DataFrame:
    """Top ``k`` per query, equal contents once, at most ``top_k`` per company.

    Ranking moves ids and scores only. The content is joined back to the winners, of which there
    are at most ``k`` per query; the engine decides how.
    """
    winners = rt.search_company(store.select("company", "chunk_key", "embedding"), queries, k)
    hits = store.drop("embedding").join(winners, ["company", "chunk_key"])
    return rt.cap_hits(rt.dedupe_ordered(hits), top_k)


def contexts(companies: DataFrame, store: DataFrame, queries: DataFrame, k: int = 3, top_k: int = 15) -> DataFrame:
    return rt.context_texts(companies, retrieve(store, queries, k, top_k))
