"""Reading tables and walking over Arrow batches in bounded pieces."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from venturelens.session import ship_package

BATCH_ROWS = 1000  # rows of an Arrow batch; texts are wide
PIECE_BYTES = 2 << 20  # text bytes that one step of a Python task works on (a single longer text is one step)


def prepare(spark: SparkSession) -> None:
    """The package on the executors, and Arrow batches of few rows, as a row holds a whole text."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 of each string; None for null."""
    return column.cast(pa.binary()).to_pylist()


def pieces(batches: Iterator[pa.RecordBatch], text: str | None = None, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of the column ``text`` each, at least a row."""
    for batch in batches:
        n = batch.num_rows
        if text is None or n == 0:
            if n:
                yield batch
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to
    pa.default_memory_pool().release_unused()  # an idle worker shouldn't hold what its last task needed


def gathered(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows in ``pieces`` of about ``limit`` bytes of text, small batches put together."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for piece in pieces(batches, text, limit):
        n = pa.compute.sum(pa.compute.binary_length(piece.column(text))).as_py() or 0
        if held and size + n > limit:
            yield joined()
            held, size = [], 0
        held.append(piece)
        size += n
    if held:
        yield joined()


_KEPT: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a worker keeps between tasks for one operator; another operator's goes, as workers are used again."""
    if key not in _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _KEPT[key] = make()
    return _KEPT[key]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (between ASCII white space), one text after another, and the texts' word counts; null texts have none."""
    split = pa.compute.ascii_split_whitespace(pa.compute.fill_null(texts, ""))
    coded = split.flatten().dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_pylist()
    sizes = split.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(coded):
        return np.zeros(0, np.uint64), sizes
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
    at = coded.indices.to_numpy(zero_copy_only=False)
    filled = np.fromiter(map(len, distinct), np.int64, len(distinct))[at] > 0  # white space at an end gives empty words
    before = np.concatenate([[0], np.cumsum(filled)])
    ends = before[np.concatenate([[0], np.cumsum(sizes)])]
    return hashes[at[filled]], np.diff(ends)


def crc32_mod(key: Column | str, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; null for null keys."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(column.cast("string")) % F.lit(n)


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each length, one after another."""
    total = int(lengths.sum())
    starts = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) - np.repeat(starts, lengths)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
