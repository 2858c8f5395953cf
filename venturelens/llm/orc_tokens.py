"""Token ids in ORC files: run-length encoded integers, row indexes and Bloom filters on document ids.

Documents are range-partitioned and sorted by id, encoded, and written by Spark's ORC writer; integer columns are run-length
encoded by the format. Each file covers a range of ids, each stripe and row group has minimum and maximum, and a Bloom filter
tells which stripes may hold an id, so lookups read a few row groups and scans read stripes in parallel. A column ``row``
(file number and place in it) keeps the order of the rows, whatever task reads which stripe.

Encoding is the tokenizers library's. Its tokenizer drops white space and never joins across it, so the library sees each distinct
unit of a piece once, and its ids are remembered up to a bound.

Defined results: null and empty texts are written as the end id alone; documents with a null id come first; rows with
equal ids follow one another in the order of a hash of their text; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venturelens.llm.common import gathered, kept
from venturelens.llm.unit_memory import UnitMemory
from venturelens.session import scratch_path

LINE_UNITS = 256
WORD_THEN_SIGN, SIGN_THEN_WORD = r"([0-9a-z])([!-&(-/:-@\[-`{-~])", r"([!-&(-/:-@\[-`{-~])([0-9a-z])"
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
}


class Encoder:
    """The library's tokenizer, asked once for each distinct unit of a worker's texts.

    A unit stands between ASCII white space, or between an ASCII letter or digit and an ASCII sign that isn't an apostrophe:
    the tokenizer always cuts there. It lower-cases and doesn't see case otherwise, so units are lower-cased first.
    Texts that may hold a special token go to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memory = UnitMemory(self._fresh)
        (self.bar,) = self._ids(["|"])[0]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each unit and all ids: units go in as lines with a bar between them, whose id parts them again."""
        length, parts = np.zeros(len(units), np.int64), []
        texts = [u.decode("utf-8") for u in units]
        at = 0
        while at < len(units):
            if "|" in texts[at]:
                parts += self._ids([texts[at]])
                length[at] = len(parts[-1])
                at += 1
                continue
            to = at
            while to < min(len(units), at + LINE_UNITS) and "|" not in texts[to]:
                to += 1
            (ids,) = self._ids([" | ".join(texts[at:to])])
            bars = ids == self.bar
            cuts = np.flatnonzero(bars)
            length[at:to] = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
            parts.append(ids[~bars])
            at = to
        return length, np.concatenate(parts)

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, and where each text's ids begin."""
        special = pa.compute.fill_null(pa.compute.match_substring(texts, "<|"), False)
        plain = pa.compute.ascii_lower(pa.compute.if_else(special, "", pa.compute.fill_null(texts, "")))
        for pattern in (WORD_THEN_SIGN, SIGN_THEN_WORD):
            plain = pa.compute.replace_substring_regex(plain, pattern, r"\1 \2")
        split = pa.compute.ascii_split_whitespace(plain)
        length, flat = self.memory.take(split.flatten().cast(pa.binary()))
        before = np.concatenate([[0], np.cumsum(length)])
        cuts = before[np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)]
        whole = np.flatnonzero(special.to_numpy(zero_copy_only=False))
        if len(whole):
            found = self._ids(texts.take(pa.array(whole)).to_pylist())
            sizes = np.array([len(x) for x in found], np.int64)
            flat = np.insert(flat, np.repeat(cuts[whole], sizes), np.concatenate(found))
            more = np.zeros(len(texts), np.int64)
            more[whole] = sizes
            cuts = cuts + np.cumsum(more)
        starts = np.concatenate([[0], cuts + np.arange(1, len(texts) + 1)])
        return np.insert(flat, cuts, end), starts.astype(np.int32)


def encoded(docs: DataFrame, tokenizer: str, end: int, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` in the rows' order."""
    kind = docs.schema[id_].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(("orc", tokenizer), lambda: Encoder(tokenizer))
        for b in gathered(batches, "_text", 8 << 20):
            ids, starts = encoder.encode(b.column("_text"), end)
            lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(ids))
            yield pa.RecordBatch.from_arrays([b.column("_id"), lists], ["doc_id", "ids"])

    narrow = docs.select(F.col(id_).alias("_id"), F.col(text).alias("_text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def write_orc(docs: DataFrame, tokenizer: str, path: str, end: int, id_: str = "doc_id", text: str = "text", options: dict[str, str] | None = None) -> None:
    """Writes ``doc_id, row, ids`` in ascending order of ids over the files."""
    narrow = docs.select(F.col(id_).alias("doc_id"), F.col(text).alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    numbered = encoded(ordered, tokenizer, end).select("doc_id", F.monotonically_increasing_id().alias("row"), "ids")
    numbered.write.mode("overwrite").options(**{**ORC_OPTIONS, **(options or {})}).orc(path)


def lookup(spark: SparkSession, path: str, ids: Sequence[int]) -> DataFrame:
    """The rows of some documents: the filter reaches the files' statistics and Bloom filters."""
    return spark.read.orc(path).filter(F.col("doc_id").isin(list(ids)))


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document in the files, read stripe by stripe.

    ``start`` is the number of ids before the document. Places are summed within a file first and then over the files'
    totals, which are one row per file.
    """
    stored = spark.read.orc(path)
    kind = stored.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("ids")
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy().astype("<u4", copy=False)
            crc = [zlib.crc32(values[i:j]) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row"), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())], ["doc_id", "row", "n_tokens", "ids_crc32"]
            )

    narrow = stored.select("doc_id", "row", "ids").mapInArrow(run, f"doc_id {kind}, row long, n_tokens long, ids_crc32 long")
    place = scratch_path(spark, "token-places")
    narrow.withColumn("file", F.shiftright("row", 33)).write.parquet(place)  # the wide files are read once
    rows = spark.read.parquet(place)
    before = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    over = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("file", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("offset"))
    return inside.join(offsets, "file").select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
