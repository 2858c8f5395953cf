"""Rows of a wide table whose ids are, or aren't, in a table of ids, without a shuffle of the wide rows.

Up to ``FEW`` ids are broadcast. Of more ids a Bloom filter of bounded size is broadcast: it lets all wanted rows pass and some others, few
unless there are far more ids than bits. A scalar function tests the ids alone; the other columns don't reach Python.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venturelens.llm.sparse_suffix import mixed
from venturelens.session import shuffles_freed

FEW = 1 << 20  # ids
BITS_OF_ID = 16
MOST_BITS = 1 << 27
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _places(ids: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for seed in SEEDS:
        yield (mixed(ids.view(np.uint64) ^ np.uint64(seed)) % np.uint64(bits)).astype(np.int64)


def bloom(ids: DataFrame, n: int) -> np.ndarray:
    """A bitmap (a power of two of bits) of the first column, ``n`` long integers without null."""
    bits = min(MOST_BITS, 1 << max(16, (BITS_OF_ID * n - 1).bit_length()))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(bits // 8, np.uint8)
        for b in batches:
            for at in _places(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64), bits):
                np.bitwise_or.at(found, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(found.tobytes(), 1)], pa.binary())], ["found"])

    total = np.zeros(bits // 8, np.uint8)
    with shuffles_freed(ids.sparkSession):
        for r in ids.coalesce(8).mapInArrow(partial, "found binary").toLocalIterator():
            total |= np.frombuffer(zlib.decompress(bytes(r["found"])), np.uint8)
    return total


def may_hold(id_: Column, ids: DataFrame, n: int) -> Column:
    """True for all ids of ``ids`` and few others, false for null."""
    shared = ids.sparkSession.sparkContext.broadcast(bloom(ids, n))

    @F.arrow_udf("boolean")
    def test(values: pa.Array) -> pa.Array:
        found = shared.value
        known = values.is_valid().to_numpy(zero_copy_only=False)
        own = pa.compute.fill_null(values, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for at in _places(own, 8 * len(found)):
            known = known & ((found[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
        return pa.array(known, pa.bool_())

    return test(id_)


def among(rows: DataFrame, id_: str, ids: DataFrame, few: int = FEW) -> DataFrame:
    """The rows whose ``id_`` is in ``ids`` (one column of distinct long integers, stored), and perhaps a few others."""
    n, ids = ids.count(), ids.toDF(id_)
    return rows.join(F.broadcast(ids), id_, "left_semi") if n <= few else rows.filter(may_hold(F.col(id_), ids, n))


def without(rows: DataFrame, id_: Column, ids: DataFrame, few: int = FEW) -> DataFrame:
    """The rows whose ``id_`` isn't in ``ids`` (one column of distinct long integers, stored); its name is none of the rows'."""
    n, same = ids.count(), id_ == F.col(ids.columns[0])
    if n <= few:
        return rows.join(F.broadcast(ids), same, "left_anti")
    may = may_hold(id_, ids, n)
    return rows.filter(~may).unionByName(rows.filter(may).join(ids, same, "left_anti"))
