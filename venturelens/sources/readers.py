"""Readers of seed lists, page files, crawl metadata, records and payloads.

Schemas are always given, never inferred. Paths are folders or globs on any Spark file system.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from venturelens import schemas as S
from venturelens import vocabulary as V
from venturelens.functions.text import strip
from venturelens.operators.skew import keyed_join, union_rows
from venturelens.sources.writers import page_bucket


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """Companies of a JSON array, or of an object with a ``companies`` array; nothing if missing or bad."""
    kind = f"array<struct<{S.SEED}>>"
    try:
        texts = spark.read.text(path, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], S.SEED)
    plain = F.from_json("value", kind)
    wrapped = F.from_json("value", f"struct<companies:{kind}>")["companies"]
    is_list = F.startswith(F.ltrim("value"), F.lit("["))
    return texts.select(F.inline(F.when(is_list, plain).otherwise(wrapped))).filter(
        F.coalesce("company_id", "company_name").isNotNull()
    )


def _path_parts(back: int) -> Column:
    """A part of the file path counted from the end (1 = file name)."""
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -back)


PACKED = (".bz2", ".deflate", ".gz", ".lz4", ".snappy", ".zst", ".zstd")  # endings that the text source unpacks
PARTITION_LAYOUT = r"/company_id=([^/]+)/page_type=([^/]+?)(?:/[^/]+|\.txt)$"


def read_page_files(
    spark: SparkSession, path: str, page_types: Sequence[str] | None = V.PAGE_TYPES, suffix: str = "txt", folder_level: int = 2, layout: str | None = None
) -> DataFrame:
    """(company_id, page_type, file_path, text) of ``<company>/<page type>.txt``, whole files.

    ``page_types=None`` takes every text file. ``folder_level`` is the company folder's place from
    the end (3 where dated run folders lie between). ``layout`` is for any other naming: a pattern over the path whose first two
    groups are company and page type, as ``PARTITION_LAYOUT`` for what ``writers.write_page_files`` or Spark wrote; files that it doesn't fit are left out.
    """
    company, stem = _path_parts(folder_level), F.regexp_replace(_path_parts(1), rf"\.{suffix}$", "")
    if layout:
        company, stem = (F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), layout, i)) for i in (1, 2))
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{suffix}")
    if f".{suffix}".endswith(PACKED):
        found, text = found.text(path, wholetext=True), F.col("value")
    else:  # the same bytes; the text source copies Hadoop's whole configuration for each file
        found, text = found.format("binaryFile").load(path), F.col("content").cast("string")
    files = found.select(
        company.alias("company_id"),
        stem.alias("page_type"),
        F.col("_metadata.file_path").alias("file_path"),
        text.alias("text"),
    )
    if layout:
        files = files.filter(F.col("page_type") != "")
    return files.filter(F.col("page_type").isin(list(page_types))) if page_types else files


def long_texts(files: DataFrame, min_chars: int = V.MIN_FILE_CHARS) -> DataFrame:
    """Files whose stripped text has at least ``min_chars`` characters."""
    return files.filter(F.length(strip(F.col("text"))) >= min_chars)


def company_objects(paths: DataFrame, column: str = "path", seed_file: str = "seed.json") -> DataFrame:
    """Listed object keys inside a company folder: no root files, folder markers or the seed list."""
    key = F.col(column)
    return paths.filter(
        F.contains(key, F.lit("/")) & ~F.endswith(key, F.lit("/")) & (key != F.lit(seed_file))
    )


def list_objects(spark: SparkSession, path: str) -> DataFrame:
    """Keys (relative to ``path``) and sizes of all files below ``path``; contents are not read."""
    root = path.rstrip("/") + "/"
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.substring_index("path", root, -1).alias("path"), F.col("length"), "modificationTime"
        )
    )


def subset(df: DataFrame, ids: str | None = None, one: str | None = None, key: str = "company_id") -> DataFrame:
    """One id, else a comma list (trimmed, blanks dropped), else everything."""
    if one:
        return df.filter(F.col(key) == one)
    wanted = [x.strip() for x in (ids or "").split(",") if x.strip()]
    return df.filter(F.col(key).isin(wanted)) if wanted else df


def subset_by(df: DataFrame, lists: DataFrame, key: str = "company_id", column: str = "ids") -> DataFrame:
    """As ``subset`` for id lists held in a table (any number of ids)."""
    ids = lists.select(F.explode(F.split(column, ",")).alias(key)).select(F.trim(key).alias(key))
    wanted = ids.filter(F.col(key) != "").distinct()
    return keyed_join(df, wanted, [key], "left_semi")


def read_pages(spark: SparkSession, path: str, run_date: str | None = None, company_id: str | None = None) -> DataFrame:
    """The page table; a run date or company reads only its partition folders."""
    pages = spark.read.parquet(path)
    if run_date:
        pages = pages.filter(F.col("run_date") == F.lit(run_date).cast("date"))
    if company_id:
        pages = pages.filter(F.col("company_id") == company_id)
        if "company_bucket" in pages.columns:
            pages = pages.filter(F.col("company_bucket") == page_bucket(F.lit(company_id)))
    return pages.drop("company_bucket")


def read_crawl_metadata(
    spark: SparkSession, path: str, files: str = "metadata.json", multi_line: bool = True
) -> DataFrame:
    """(company_id, page_type, source_url, crawled_at, status, text_length) of both metadata layouts.

    By default one JSON document per company folder; ``files="*.json", multi_line=False`` reads
    many companies per file, one per line.
    """
    raw = (
        spark.read.schema(S.CRAWL_METADATA)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", files)
        .json(path)
        .withColumn("_folder", _path_parts(2))
    )
    key = F.coalesce("company_id", "_folder").alias("company_id")
    by_url = raw.select(key, "timestamp", F.explode("success").alias("page_type", "source_url")).select(
        "company_id",
        "page_type",
        "source_url",
        F.col("timestamp").alias("crawled_at"),
        F.lit("success").alias("status"),
        F.lit(None).cast("int").alias("text_length"),
    )
    by_page = raw.select(key, "crawled_at", F.explode("pages").alias("page_type", "_p")).select(
        "company_id",
        "page_type",
        F.col("_p.url").alias("source_url"),
        "crawled_at",
        F.col("_p.status").alias("status"),
        F.col("_p.text_length").alias("text_length"),
    )
    return union_rows([by_url, by_page])


def with_source(pages: DataFrame, metadata: DataFrame, now: str, tie: str = "source_url") -> DataFrame:
    """Source URL and crawl time per page; first entry wins, else an empty URL and the run time."""
    keys = ["company_id", "page_type"]
    first = metadata.groupBy(*keys).agg(F.min_by(F.struct("source_url", "crawled_at"), tie).alias("_m"))
    return (
        pages.drop("source_url", "crawled_at")
        .join(first, keys, "left")
        .withColumn("source_url", F.coalesce("_m.source_url", F.lit("")))
        .withColumn("crawled_at", F.coalesce("_m.crawled_at", F.lit(now)))
        .drop("_m")
    )


def read_records(spark: SparkSession, path: str, file_per_company: bool = True) -> DataFrame:
    """Structured records. ``company_id`` is the file stem, or the record's own where files hold many lines."""
    raw = (
        spark.read.schema(S.STRUCTURED_RECORD)
        .option("multiLine", file_per_company)
        .option("pathGlobFilter", "{*.json,*.json.gz}")
        .json(path)
    )
    stem = F.regexp_replace(_path_parts(1), r"\.json(\.gz)?$", "")
    return raw.withColumn("company_id", stem if file_per_company else F.col("company.company_id"))


def read_record_items(spark: SparkSession, path: str) -> DataFrame:
    """(company_id, entity, pos, json) items of the record files, unparsed, for ``records.validate``."""
    lists = {n: "array<string>" for n in S.CHILDREN}
    shape = "company string, " + ", ".join(f"{n} {t}" for n, t in lists.items())
    raw = (
        spark.read.option("pathGlobFilter", "*.json")
        .text(path, wholetext=True)
        .select(
            F.regexp_replace(_path_parts(1), r"\.json$", "").alias("company_id"),
            F.from_json("value", shape).alias("r"),
        )
    )
    none = F.array().cast("array<string>")
    packs = [F.struct(F.lit("company").alias("entity"), F.array("r.company").alias("items"))]
    packs += [F.struct(F.lit(n).alias("entity"), F.coalesce(f"r.{n}", none).alias("items")) for n in S.CHILDREN]
    return raw.select("company_id", F.inline(F.array(*packs))).select(
        "company_id", "entity", F.posexplode("items").alias("pos", "json")
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(S.PAYLOAD)
        .json(path)
        .withColumn("company_id", F.col("company_record.company_id"))
    )


def read_payload_parts(spark: SparkSession, path: str, schema: StructType | str, company_schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """The company records and the parts written by ``writers.write_payload_parts``; ``schema`` is that of the parts."""
    return spark.read.schema(company_schema).json(f"{path}/company"), spark.read.schema(schema).json(f"{path}/parts")


def companies_with_files(files: DataFrame, leave_out: Sequence[str] = ("vector_db",)) -> DataFrame:
    """Company folders that exist, without the store's own folder."""
    return files.select("company_id").filter(~F.col("company_id").isin(list(leave_out))).distinct()


def check_targets(targets: DataFrame, seed: DataFrame, key: str = "company_id") -> DataFrame:
    """Each requested id with a status: ok, not_in_seed or no_website; the name falls back to ``Unknown``."""
    s = seed.select(
        key,
        F.coalesce("legal_name", "company_name", F.lit("Unknown")).alias("name"),
        F.col("website"),
        F.lit(True).alias("_in"),
    )
    joined = targets.select(key).join(s, key, "left")
    no_site = F.coalesce("website", F.lit("")) == ""
    return joined.select(
        key,
        F.coalesce("name", F.lit("Unknown")).alias("name"),
        F.when(F.col("_in").isNull(), "not_in_seed").when(no_site, "no_website").otherwise("ok").alias("status"),
    )
