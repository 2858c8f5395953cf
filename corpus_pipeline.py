"""A training-text pipeline: toxicity filter, near duplicates, repeated passages, decontamination, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir), where ``docs`` has the columns of the table
``documents``, and returns the rows for the next stage. ``run`` applies them to the table, each result written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venturelens.llm import bpe, decontaminate, jaccard, sparse_suffix, toxicity
from venturelens.llm.common import prepare, table
from venturelens.session import scratch_path

TOXIC_FROM = 0.3
SHINGLE_WORDS, SIMILARITY = 5, (80, 100)
PASSAGE_WORDS = 50
BENCHMARK_WINDOW = 10


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain scores below ``TOXIC_FROM``; it learns from the table ``labels``."""
    prepare(spark)
    return toxicity.remove_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    prepare(spark)
    return jaccard.keep_first(docs, size=SHINGLE_WORDS, numerator=SIMILARITY[0], denominator=SIMILARITY[1])


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stand in an earlier document; ``n_chars`` follows the text."""
    prepare(spark)
    cut = sparse_suffix.cut_repeats(docs, passage=PASSAGE_WORDS)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    prepare(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), BENCHMARK_WINDOW)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` and ``text``, decoded from the ids again."""
    prepare(spark)
    both = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("sparse_suffix", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode_tokens),
]

# The toxicity model is trained, so SQL can't say which documents stay; the tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
