import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that other steps use inside.
CLASHES = ["_id", "_text", "_key", "_cut", "_dropped", "_row", "_h1", "ids", "score", "host", "window", "places", "h1", "kept", "_salt", "component_id"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows and clashing extra columns."""
    from pyspark.sql import functions as F

    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(30000))
    rows = [
        (1, None, "en", "a", None),
        (2, "", None, "a", 0),
        (3, " \n\t ", "fr", None, 4),
        (4, long_text, "en", "a", len(long_text)),
        (5, long_text + " end", "en", "b", None),
        (6, "you are an idiot and a moron, really", "en", "a", 10),
        (6, "you are an idiot and a moron, really", "en", "a", 10),
        (7, "x" * 20000, "de", "c", 20000),
        (8, "one two three four five six", "en", None, 3),
        (9, "one two three four five six", "en", "b", 3),
        (None, "a row without an id", None, None, None),
        (10, "ünï cödé 日本語 👍🏽 <|endoftext|> it's 123", "xx", "a", 5),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")


@pytest.fixture(scope="session")
def small(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
