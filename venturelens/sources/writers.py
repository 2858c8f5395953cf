"""Sinks. Run-dated tables overwrite only their own partitions, so a rerun changes nothing else."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venturelens.functions.urls import folder_slug


PAGE_BUCKETS = 64


def page_bucket(company: Column) -> Column:
    return F.pmod(F.xxhash64(company), F.lit(PAGE_BUCKETS)).cast("int")


def write_pages(pages: DataFrame, path: str) -> None:
    """Pages by run date and bucket of the company, so that a reader of one company opens one folder a date.

    The rebalance gives each folder files of even size and splits a large one.
    """
    (
        pages.withColumn("company_bucket", page_bucket(F.col("company_id")))
        .hint("rebalance", "run_date", "company_bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date", "company_bucket")
        .parquet(path)
    )


PAGE_FILE_END = "\x01"
PAGE_FILE_PARTS = 64  # folders of a batch; Spark lists more than 32 folders in as many tasks
PART_PAGES = 1_500
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for null and empty values


def write_page_files(pages: DataFrame, path: str, part_pages: int = PART_PAGES) -> list[str]:
    """Pages as text files below a new folder, ``batch=<n>/part=<n>/company_id=<id>/page_type=<type>.txt``; returns the folders of the batches.

    In a store that only Spark reaches, ``page_type=<type>`` is a folder of one file; ``readers.PARTITION_LAYOUT`` fits both.
    A file is the text and ``PAGE_FILE_END``; rows of one company and type share a file. A company is whole in one part, and a batch is
    64 parts of about ``part_pages`` pages, so a reader that takes batch after batch lists files in bounded numbers, many to a task.
    """
    spark = pages.sparkSession
    keys = ["company_id", "page_type"]
    rows = pages.select(*[F.coalesce(F.nullif(F.col(k).cast("string"), F.lit("")), F.lit(NO_VALUE)).alias(k) for k in keys], "text")
    batches = max(1, -(-rows.count() // (part_pages * PAGE_FILE_PARTS)))
    parts = batches * PAGE_FILE_PARTS
    part = F.pmod(F.hash("company_id"), F.lit(parts))
    dealt = rows.repartition(parts, "company_id").select(F.floor(part / PAGE_FILE_PARTS).cast("int").alias("batch"), part.alias("part"), *keys, "text")
    folder = _local_folder(spark, path)
    if folder is None:
        dealt.write.partitionBy("batch", "part", *keys).option("lineSep", PAGE_FILE_END).text(path)
        written = dealt.select("batch")
    elif os.path.exists(folder):
        raise FileExistsError(folder)
    else:
        ordered = dealt.sortWithinPartitions(*keys).withColumn("text", F.col("text").cast("binary"))
        written = ordered.mapInArrow(_page_file_writer(folder), "batch int")
    return [f"{path}/batch={r.batch}" for r in written.distinct().orderBy("batch").collect()]


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """The folder that ``path`` is for Python, if it lies in Hadoop's local file system."""
    at = urlsplit(path)
    scheme = at.scheme or urlsplit(spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")).scheme
    if scheme != "file":
        return None
    return os.path.abspath(at.path if at.scheme else path)


def _partition_name(column: str, value: str) -> str:
    """A partition's name as Spark writes it."""
    return f"{column}=" + re.sub(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)


def _page_file_writer(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes the sorted rows of a task below a local folder; gives back the batches that it wrote to.

    Spark's own writer goes through Hadoop's local file system, which without its native library starts a process for each permission
    it sets, several a page, and adds checksum files. A file gets its name when it is whole, and a repeated task writes the same files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun = f"_{TaskContext.get().taskAttemptId()}"
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
        wrote = set()
        for (batch, part, company, kind), same in groupby(rows, key=lambda row: row[:4]):
            folder = os.path.join(root, f"batch={batch}", f"part={part}", _partition_name("company_id", company))
            os.makedirs(folder, exist_ok=True)
            with open(os.path.join(folder, begun), "wb") as f:
                for *_, text in same:
                    f.write((text or b"") + PAGE_FILE_END.encode())
            os.replace(os.path.join(folder, begun), os.path.join(folder, _partition_name("page_type", kind) + ".txt"))
            wrote.add(batch)
        yield pa.RecordBatch.from_pydict({"batch": pa.array(sorted(wrote), pa.int32())})

    return write


def write_daily(pages: DataFrame, path: str, date: str, company_name: str = "company_name") -> None:
    """Pages of one day under ``run_id=daily_<date>``; the day's earlier content is replaced."""
    (
        pages.withColumn("run_id", F.lit(f"daily_{date}"))
        .withColumn("folder", folder_slug(F.col(company_name)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def write_records(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """One JSON line per company; dates become ISO text."""
    records.write.mode("overwrite").option("compression", compression).json(path)


def write_record_texts(records: DataFrame, path: str, columns: Sequence[str], key: str = "company_id") -> None:
    """The record as JSON text with its six members, in parquet keyed by company."""
    records.select(key, F.to_json(F.struct(*columns)).alias("json")).write.mode("overwrite").parquet(path)


def write_payloads(payloads: DataFrame, path: str, compression: str = "none") -> None:
    """Payloads as JSON lines, nulls kept. Most of the text is field names, so many payloads are better written with gzip."""
    payloads.write.mode("overwrite").option("compression", compression).option("ignoreNullFields", "false").json(path)


def write_payload_parts(company: DataFrame, parts: DataFrame, path: str, key: str = "company_id") -> None:
    """Payloads of any size: the company records, and the parts of their lists as JSON lines, in gzip files.

    Parts are dealt out by ranges of company, entity and part, so files are of like size and list a company's parts in order. They
    stream from the sorted rows; no company is held whole.
    """
    company.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", "false").json(f"{path}/company")
    order = [key, "entity", "part"]
    parts.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("compression", "gzip").json(f"{path}/parts")


def append_chunks(chunks: DataFrame, path: str) -> None:
    """Plain append to the chunk store (rows already there stay; see ``plans.refresh`` for the repeatable form).

    Partitioned by a bucket of the company, which keeps folders bounded and still prunes by company.
    """
    bucketed(chunks).hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(path)


BUCKETS = 256


def bucketed(df: DataFrame, key: str = "company") -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))


def read_company_chunks(spark: SparkSession, path: str, company: str) -> DataFrame:
    """Chunks of one company: reads that company's bucket folder only."""
    return spark.read.parquet(path).filter(
        (F.col("bucket") == F.pmod(F.xxhash64(F.lit(company)), F.lit(BUCKETS)).cast("int"))
        & (F.col("company") == company)
    )


def write_report(report: DataFrame, path: str) -> None:
    """A report of one or a few aggregate rows as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_log(results: DataFrame, path: str) -> None:
    """Per-item results (ingest log, indexing results) as JSON lines, as many files as needed."""
    results.write.mode("overwrite").json(path)


def replace_seed(spark: SparkSession, seed: DataFrame, path: str, version: str) -> str:
    """Writes a new version folder next to the old ones and returns it; the input is never overwritten."""
    target = f"{path.rstrip('/')}/version={version}"
    seed.write.mode("overwrite").json(target)
    return target
