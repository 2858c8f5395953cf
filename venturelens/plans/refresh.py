"""Incremental refresh: only new or changed pages are chunked and added to the store, and chunks of replaced versions are told apart."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venturelens.operators import retrieval as rt
from venturelens.operators import runs
from venturelens.session import scratch_path
from venturelens.sources.writers import bucketed


def store_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or no rows before the first run."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


STORE = (
    "company string, source string, file_path string, chunk_id int, content string, "
    "text_hash string, batch string, bucket int"
)


PAGE = ("company", "source", "file_path")
HASHES = "company string, source string, text_hash string, file_path string, batch string, bucket int"
VERSIONS = "company string, source string, file_path string, text_hash string, batch string, bucket int"
INDEX_BUCKETS = 64  # folders of each index that a batch writes at most


def _hash_bucket() -> Column:
    """By the first six bits of the text's hash."""
    return F.shiftright(F.conv(F.substring("text_hash", 1, 2), 16, 10).cast("int"), 2)


def _page_bucket() -> Column:
    return F.pmod(F.xxhash64(*PAGE), F.lit(INDEX_BUCKETS)).cast("int")


def _read_buckets(spark: SparkSession, path: str, schema: str, rows: DataFrame, bucket: Column, batch: str) -> DataFrame:
    """What other batches left in the index's buckets that ``rows`` fall into; the other buckets aren't read."""
    touched = [r["bucket"] for r in rows.select(bucket.alias("bucket")).distinct().collect()]  # at most INDEX_BUCKETS numbers
    return store_or_empty(spark, path, schema).filter(F.col("bucket").isin(touched) & (F.col("batch") != batch))


def _write_batch(rows: DataFrame, path: str, batch: str) -> None:
    out = rows.withColumn("batch", F.lit(batch)).hint("rebalance", "bucket")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "bucket").parquet(path)


def refresh_store(spark: SparkSession, pages: DataFrame, path: str, batch: str, key_pages: tuple[str, ...] | None = None) -> DataFrame:
    """Adds the chunks of changed pages under ``batch=<id>``; a rerun of the batch writes the same rows.

    ``pages`` has company, source (page type), file_path and text. The chunks' hashes stand in an index in buckets by the hash's first digits, and each page's
    versions in another in buckets by page, so a batch reads only the buckets that its own pages fall into. Of equal pages in a batch the first by path is
    stored; pages without text change nothing. Batch ids order the versions; of several texts of a page in one batch that with the greatest hash
    counts. The rows of the batch itself are left out of the comparison, so a repeated batch overwrites its own folders with themselves.
    """
    wanted = pages.filter(F.col("source").isin(list(key_pages))) if key_pages else pages
    hashed = runs.with_hash(wanted.filter(F.col("text").isNotNull()))
    scratch = scratch_path(spark, "batch-hashes")
    hashed.select(*PAGE, "text_hash").write.parquet(scratch)
    narrow = spark.read.parquet(scratch)
    text_key = ["company", "source", "text_hash"]
    seen = _read_buckets(spark, f"{path}/_hashes", HASHES, narrow, _hash_bucket(), batch).select(*text_key)
    new = runs.first_of_copies(narrow.join(seen, text_key, "left_anti"), text_key, "file_path")
    page_key = [*PAGE, "text_hash"]
    # One page is left of each text, so copies are equal in the join's keys: they are dropped where the join has brought them, and texts move once.
    texts = hashed.select(*page_key, "text").join(new.select(*page_key), page_key, "left_semi").dropDuplicates(page_key)
    chunks = rt.chunk_rows(texts, keep=("text_hash",))
    _write_batch(bucketed(chunks), path, batch)
    _write_batch(new.select(*text_key, "file_path", _hash_bucket().alias("bucket")), f"{path}/_hashes", batch)
    versions = _read_buckets(spark, f"{path}/_pages", VERSIONS, narrow, _page_bucket(), batch)
    before = current_versions(versions).withColumnRenamed("text_hash", "_before")
    now = narrow.groupBy(*PAGE).agg(F.max("text_hash").alias("text_hash"))
    changed = now.join(before, list(PAGE), "left").filter(F.col("_before").isNull() | (F.col("_before") != F.col("text_hash")))
    _write_batch(changed.select(*PAGE, "text_hash", _page_bucket().alias("bucket")), f"{path}/_pages", batch)
    return spark.read.schema(STORE).parquet(path).filter(F.col("batch") == batch)


def current_versions(versions: DataFrame) -> DataFrame:
    """The hash of each page's latest version."""
    return versions.groupBy(*PAGE).agg(F.max_by("text_hash", "batch").alias("text_hash"))


def marked_chunks(spark: SparkSession, path: str) -> DataFrame:
    """All chunks of the store with ``current``: whether a page's latest version has their text. A text that a page returns to is current again."""
    now = current_versions(store_or_empty(spark, f"{path}/_pages", VERSIONS)).select("company", "source", "text_hash").distinct()
    chunks = spark.read.schema(STORE).parquet(path)
    return chunks.join(now.withColumn("current", F.lit(True)), ["company", "source", "text_hash"], "left").withColumn("current", F.coalesce("current", F.lit(False)))
