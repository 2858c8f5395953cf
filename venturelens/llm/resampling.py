"""Importance resampling towards a target distribution, with the cutoff found in a bracket of a quantile sketch.

1. Features of a text (runs of words) fall into ``buckets`` by a checksum. Both collections are counted by bucket; a bucket's
   gain is the floored, scaled log-ratio of its smoothed frequencies. The gains are one array of fixed length.
2. A document's weight is the sum of the gains of its features, taken from that array. Weight plus Gumbel noise,
   a function of seed and id, is the score; the ``share`` of the eligible documents with the highest scores are drawn without replacement.
3. A quantile sketch of the scores gives a bracket around the cutoff. Exact counts above and inside the bracket validate it or
   widen it; only the bracket's rows are sorted to locate the cutoff. The drawn rows are then numbered in the order of their scores,
   by a range partitioning whose partitions are numbered each by itself. No row meets all others.

Words: A-Z are lower-cased, ASCII characters that are neither letter nor digit separate. Defined results: null and empty texts have no features
and weight 0; a null id has the noise of an empty id and comes last among ties; repeated rows are drawn each by itself, ties
after score and id in the order of reading; an empty table gives an empty result, an empty target only smoothing; other columns don't matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venturelens.llm.common import pieces, ranges
from venturelens.llm.decontaminate import FOLDED, words_of
from venturelens.operators.skew import union_rows
from venturelens.session import scratch_path

ERROR = 0.002  # rank error of the sketch, as a share of the rows; half the bracket's first width


def split_words(texts: pa.Array) -> pa.ListArray:
    """The words of each text; null texts have none."""
    texts = pa.compute.fill_null(texts, "")
    if len(texts):
        _, offsets, data = texts.buffers()
        folded = pa.py_buffer(data.to_pybytes().translate(FOLDED)) if data is not None else data
        texts = pa.Array.from_buffers(pa.string(), len(texts), [None, offsets, folded], offset=texts.offset)
    split = pa.compute.ascii_split_whitespace(texts)
    words = split.flatten()
    filled = np.asarray(pa.compute.greater(pa.compute.binary_length(words), 0))
    before = np.concatenate([[0], np.cumsum(filled)])
    ends = np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(before[ends].astype(np.int32)), words.filter(pa.array(filled)))


def feature_buckets(texts: pa.Array, orders: tuple[int, int], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every feature of the texts, the number of the text it belongs to, and each text's number of words."""
    words = split_words(texts)
    sizes = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    at = coded.indices.to_numpy(zero_copy_only=False)
    found, owner = [], []
    for n in range(orders[0], orders[1] + 1):
        count = np.maximum(sizes - n + 1, 0)
        owner.append(np.repeat(np.arange(len(sizes)), count))
        if n == 1:
            found.append(np.array([zlib.crc32(w) % buckets for w in names], np.int64)[at])
            continue
        first = np.repeat(np.cumsum(sizes) - sizes, count) + ranges(count)
        runs = [at[first + k] for k in range(n)]
        found.append(np.fromiter((zlib.crc32(b" ".join([names[i] for i in run])) % buckets for run in zip(*runs, strict=True)), np.int64, len(first)))
    return np.concatenate(found), np.concatenate(owner), sizes


def bucket_counts(docs: DataFrame, orders: tuple[int, int], buckets: int, text: str = "text") -> np.ndarray:
    """Features of all texts by bucket: each task adds up an array, the arrays are summed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in pieces(batches, "_text"):
            total += np.bincount(feature_buckets(b.column("_text"), orders, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    counted = docs.select(F.col(text).alias("_text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in counted.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains_of(source: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """Floored, scaled log-ratio of the smoothed frequencies in the target and in the source."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(scale * math.log((int(b) + 1) * (s + n) / ((int(a) + 1) * (t + n)))) for a, b in zip(source, target, strict=True)], np.int64)


def weights(docs: DataFrame, gains: np.ndarray, orders: tuple[int, int], id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each document."""
    kind = docs.schema[id_].dataType.simpleString()
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "_text"):
            found, owner, sizes = feature_buckets(b.column("_text"), orders, buckets)
            total = np.zeros(b.num_rows, np.int64)
            np.add.at(total, owner, gains[found])
            n = np.bincount(owner, minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(sizes), pa.array(n), pa.array(total)], ["doc_id", "n_words", "n_features", "weight"])

    narrow = docs.select(F.col(id_).alias("_id"), F.col(text).alias("_text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(seed: int, id_: str = "doc_id", scale: int = 1000):
    """Floored, scaled Gumbel noise from the first 32 bits of a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _not_before(cut: tuple) -> F.Column:
    """Rows that come no later than ``cut`` = (score, id, row) in the order of drawing."""
    score, id_, row = cut
    same = F.col("doc_id").isNull() if id_ is None else F.col("doc_id") == F.lit(id_)
    earlier = F.col("doc_id").isNotNull() if id_ is None else F.coalesce(F.col("doc_id") < F.lit(id_), F.lit(False))
    return (F.col("score") > score) | ((F.col("score") == score) & (earlier | (F.coalesce(same, F.lit(False)) & (F.col("row") <= row))))


ORDER = ("score", "doc_id", "row")


def _order():
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3 in the order of drawing: places within range partitions, after the partitions before."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    ordered = rows.repartitionByRange(*_order()).sortWithinPartitions(*_order())
    ordered.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path).withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))})
    parts = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return stored.join(offsets, "_part").withColumn("rank", F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


def cutoff(rows: DataFrame, draws: int, total: int, error: float = ERROR) -> tuple:
    """(score, id, row) of the last of ``draws`` of the ``total`` rows in the order of drawing.

    The sketch's quantiles are the bracket; the counts of the rows above and inside are exact. As long as the cutoff isn't inside, the
    side on which it lies is moved out, at last to the end of the scores.
    """
    at, width = 1 - draws / total, error
    low = high = None
    while True:
        ask = [max(0.0, at - width), min(1.0, at + width)]
        low, high = rows.approxQuantile("score", ask, error / 2) if width < 1 else (None, None)
        above = F.lit(False) if high is None else F.col("score") > int(high)
        below = F.lit(False) if low is None else F.col("score") < int(low)
        counts = rows.agg(F.coalesce(F.sum(above.cast("long")), F.lit(0)).alias("above"), F.coalesce(F.sum(below.cast("long")), F.lit(0)).alias("below")).first()
        if counts["above"] < draws <= total - counts["below"]:
            break
        width = width * 4 if width * 4 < 0.5 else 1.0
    inside = numbered(rows.filter(~above & ~below).select(*ORDER), "bracket")
    found = inside.filter(F.col("rank") == draws - counts["above"]).first()
    return tuple(found[c] for c in ORDER)


def resample(
    docs: DataFrame, target: DataFrame, seed: int, share: tuple[int, int] = (10, 100), least_words: int = 20, orders: tuple[int, int] = (1, 1),
    buckets: int = 10_000, id_: str = "doc_id", text: str = "text", target_text: str = "text", error: float = ERROR,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of each document; ``rank`` is null where it isn't drawn."""
    spark = docs.sparkSession
    gains = gains_of(bucket_counts(docs, orders, buckets, text), bucket_counts(target, orders, buckets, target_text))
    path = scratch_path(spark, "scores")
    scored = weights(docs, gains, orders, id_, text).withColumn("score", F.col("weight") + noise(seed))
    scored.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    scored = spark.read.parquet(path)
    eligible = scored.filter(F.col("n_words") >= least_words)
    total = eligible.count()
    draws = share[0] * total // share[1]
    none = F.lit(None).cast("long")
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    if not draws:
        return scored.withColumn("rank", none).select(*columns)
    chosen = (F.col("n_words") >= least_words) & _not_before(cutoff(eligible, draws, total, error))
    drawn = numbered(scored.filter(chosen), "drawn")
    return union_rows([drawn.select(*columns), scored.filter(~chosen).withColumn("rank", none).select(*columns)])


def brute_force(docs: list[tuple], target: list[str | None], seed: int, share: tuple[int, int], least_words: int, orders: tuple[int, int], buckets: int) -> list[tuple]:
    """(id, n_features, weight, score, rank) by the definition, for tests with distinct ids."""
    import hashlib

    def features(t):
        words = words_of((t or "").encode())
        return len(words), [zlib.crc32(b" ".join(words[i : i + n])) % buckets for n in range(orders[0], orders[1] + 1) for i in range(len(words) - n + 1)]

    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in features(t)[1]:
                out[f] += 1
        return out

    s, t = counts([x for _, x in docs]), counts(target)
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[i] + 1) * (big_s + buckets) / ((s[i] + 1) * (big_t + buckets)))) for i in range(buckets)]
    rows = []
    for d, x in docs:
        n, fs = features(x)
        h = int(hashlib.sha256(f"{seed}:{d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[f] for f in fs)
        rows.append((d, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    order = sorted((r for r in rows if r[4] >= least_words), key=lambda r: (-r[3], r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(order[: share[0] * len(order) // share[1]])}
    return [(*r[:4], rank.get(r[0])) for r in rows]
