"""WARC archives: writing, reading, and resolving repeated payloads to revisit records.

Archives are written and read by Spark's text source, one record per row, so any file system of Spark will do and the
commit protocol covers lost executors. The reader splits at the line that begins a record; a payload that contains that
very line is put together again by its Content-Length, which is what ends a record.

Deduplication shuffles headers: by payload digest, the record with the smallest page id is the original (one
partial aggregate, so a digest that a third of all records share is one row per task). The verdicts on revisits are stored and counted. Up to
``BROADCAST_ROWS`` of them are sent to the tasks that read the archives, so that no payload leaves its task; more are joined, which
shuffles the records. The archives are written anew, with fresh headers: originals keep their payload, revisits name the original and carry none.

Defined results: null html is an empty payload; payloads under ``least`` bytes are never revisits; of records with the same page id
and payload one (the smallest record id) is the original; a null page id is larger than any other; a null URL is left out of
the header, and characters that would break a header line are percent-encoded; an empty table writes no record.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venturelens.llm.common import prepare
from venturelens.session import scratch_path

# Fixed values of the format.
VERSION = "WARC/1.1"
BREAK = "\r\n\r\n"
SEPARATOR = f"{BREAK}{VERSION}\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BROADCAST_ROWS = 500_000  # verdicts of about 100 bytes

HEADERS = "record_id string, page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to_id string, refers_to long"


def header_text(column: Column) -> Column:
    """A value that fits in a header line: control characters, spaces at the ends and ``%`` are percent-encoded."""
    out = F.regexp_replace(column, "%", "%25")
    for c in range(32):
        out = F.replace(out, F.lit(chr(c)), F.lit(f"%{c:02X}"))
    return F.replace(F.replace(out, F.lit(" "), F.lit("%20")), F.lit("\x7f"), F.lit("%7F"))


def _line(name: str, value: Column) -> Column:
    """``name: value`` with its line end; nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def record_text(payload: Column) -> Column:
    """A whole record without the version line that the separator brings; from columns named as in ``HEADERS``, and ``date``."""
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(payload)
    return F.concat(
        F.lit("\r\n"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.concat(F.lit("<"), "record_id", F.lit(">"))),
        _line("WARC-Date", F.col("date")),
        _line("WARC-Target-URI", header_text(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        _line("WARC-Refers-To", F.concat(F.lit("<"), "refers_to_id", F.lit(">"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("X-Page-Id", F.col("page_id").cast("string")),
        _line("X-Refers-To-Page-Id", F.col("refers_to").cast("string")),
        _line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def _write(records: DataFrame, payload: str, path: str) -> None:
    text = F.concat(F.lit(VERSION), record_text(F.col(payload)))
    # The last line end of a record is the one that the text source writes.
    rows = records.select(F.left(text, F.length(text) - F.lit(2)).alias("value"))
    rows.write.mode("overwrite").option("lineSep", "\r\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def write_pages(pages: DataFrame, path: str, date: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """One response record per page."""
    payload = F.coalesce(F.col(html), F.lit(""))
    narrow = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    name = F.md5(F.concat_ws("|", F.monotonically_increasing_id().cast("string"), F.col("page_id").cast("string")).cast("binary"))
    uuid = F.concat_ws("-", *[F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    _write(
        narrow.select(
            F.concat(F.lit("urn:uuid:"), uuid).alias("record_id"),
            "page_id",
            "url",
            F.lit("response").alias("record_type"),
            F.sha2(F.col("payload").cast("binary"), 256).alias("payload_digest"),
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.lit(None).cast("string").alias("refers_to_id"),
            F.lit(None).cast("long").alias("refers_to"),
            F.lit(date).alias("date"),
            "payload",
        ),
        "payload",
        path,
    )


def _parsed(head: bytes) -> dict[str, str]:
    fields = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.decode().lower()] = value.strip().decode("utf-8")
    return fields


def records_of(parts: Iterator[tuple[str, bytes]]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload from (file, text between separators) in the order of the file."""
    separator = SEPARATOR.encode()
    file, held = None, b""
    for name, part in parts:
        if name != file:
            file, held = name, b""
            part = part.removeprefix(f"{VERSION}\r\n".encode())
        part = held + part
        head, _, body = part.partition(b"\r\n\r\n")
        fields = _parsed(head)
        size = int(fields.get("content-length", "0"))
        if len(body) < size:  # the payload holds the separator itself
            held = part + separator
            continue
        held = b""
        if len(body) > size + 4 or body[size:].strip(b"\r\n"):
            raise ValueError(f"{name}: a record is longer than its Content-Length")
        yield fields, body[:size]


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of the archives in a folder: columns of ``HEADERS``, ``digest_read`` (of the payload as read) and, if asked for, ``payload``.

    ``payload_digest`` and ``payload_bytes`` are the header's. A file is read by one task, record by record.
    """
    prepare(spark)
    text = spark.read.option("lineSep", SEPARATOR).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    names = ["record_id", "page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to_id", "refers_to", "digest_read"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    if payload:
        names, kinds = [*names, "payload"], [*kinds, pa.string()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[str, bytes]]:
            for b in batches:
                yield from zip(b.column("file").to_pylist(), b.column("value").cast(pa.binary()).to_pylist(), strict=True)

        rows, size = [], 0
        number = lambda x: None if x is None else int(x)
        for f, body in records_of(parts()):
            url = f.get("warc-target-uri")
            row = (
                f["warc-record-id"].strip("<>"),
                number(f.get("x-page-id")),
                None if url is None else unquote_to_bytes(url).decode("utf-8"),
                f["warc-type"],
                f["warc-payload-digest"].removeprefix("sha256:"),
                number(f.get("x-payload-length")),
                None if "warc-refers-to" not in f else f["warc-refers-to"].strip("<>"),
                number(f.get("x-refers-to-page-id")),
                hashlib.sha256(body).hexdigest(),
            )
            rows.append((*row, body.decode("utf-8")) if payload else row)
            size += len(body) if payload else 0
            if len(rows) >= 1000 or size > 4 << 20:
                yield batch(rows)
                rows, size = [], 0
        if rows:
            yield batch(rows)

    return text.mapInArrow(run, HEADERS + ", digest_read string" + (", payload string" if payload else ""))


def revisits(headers: DataFrame, least: int = 100) -> DataFrame:
    """``record_id, refers_to_id, refers_to`` of each record that repeats an earlier one's payload."""
    long_ = headers.filter(F.col("payload_bytes") >= least).select("payload_digest", "payload_bytes", "page_id", "record_id")
    # Nulls come last: a struct starts with whether the id is missing.
    rank = F.struct(F.col("page_id").isNull().alias("missing"), "page_id", "record_id")
    first = long_.groupBy("payload_digest", "payload_bytes").agg(F.min(rank).alias("o"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    joined = long_.join(first.select("payload_digest", "payload_bytes", "o"), ["payload_digest", "payload_bytes"])
    return joined.filter(F.col("record_id") != F.col("o.record_id")).select(
        "record_id", F.col("o.record_id").alias("refers_to_id"), F.col("o.page_id").alias("refers_to")
    )


def deduplicate(spark: SparkSession, source: str, target: str, date: str, least: int = 100, broadcast_rows: int = BROADCAST_ROWS) -> None:
    """Reads the archives in ``source`` and writes deduplicated ones to ``target``."""
    path = scratch_path(spark, "revisits")
    revisits(read(spark, source, payload=False).drop("refers_to_id", "refers_to"), least).write.parquet(path)
    again = spark.read.parquet(path)
    if again.count() <= broadcast_rows:
        again = F.broadcast(again)
    records = read(spark, source).drop("refers_to_id", "refers_to", "record_type").join(again, "record_id", "left")
    kind = F.when(F.col("refers_to_id").isNotNull(), F.lit("revisit")).otherwise(F.lit("response"))
    _write(records.withColumn("record_type", kind).withColumn("date", F.lit(date)), "payload", target)
