"""Benchmark decontamination with training suffix arrays.

Every shard (a bounded piece of a task's documents) gets a suffix array over its words: positions sorted by the words
that follow them. Each test suffix is looked up by binary search, which gives all places of a window of
``window`` words and, along the diagonals of consecutive windows, the longest verbatim match and where it is. Suffixes
too short in benchmark words to hold a match are left out of the array: a match consists of benchmark words only.

The documents aren't shuffled, so a hot source or a passage in a third of them makes no task longer than its texts. The benchmark
is dealt into blocks of about ``block_bytes`` of text, built by Spark and stored; one block at a time is sent to the tasks, for one pass over the
documents, and let go. With one block that pass gives the result; with more, each pass stores what it found by text, and the
findings of all passes are put together. The driver never holds more than one block.

Words: A-Z are lower-cased, and what ASCII character is no letter or digit separates. An item with fewer words than the window is
one window; an item without words has none. Defined results: null and empty texts have no words and no hits; repeated rows,
items and windows each count by themselves, an item id once per document; a null item id is named by an empty text; an empty benchmark hits
nothing; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venturelens.llm.common import as_bytes, fresh, pieces, ranges
from venturelens.session import scratch_path

# Fixed value: what each byte becomes before splitting at spaces.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

BLOCK_BYTES = 8 << 20
MATCH = "struct<item_id:string,doc_start:int,item_start:int,n_words:int>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(FOLDED).split() if text else []


class Block:
    """Windows of some items, as rows of word numbers (from 1; 0 fills short windows)."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int) -> None:
        self.window = window
        self.number: dict[bytes, int] = {}
        self.items: list[str] = []
        rows, owner, offset, depth = [], [], [], []
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words]
            d = min(window, len(ids))
            for j in range(len(ids) - d + 1):
                rows.append(ids[j : j + d] + [0] * (window - d))
                owner.append(len(self.items))
                offset.append(j)
                depth.append(d)
            self.items.append(name)
        self.rows = np.array(rows, np.uint32).reshape(-1, window)
        self.owner, self.offset, self.depth = (np.array(x, np.int64) for x in (owner, offset, depth))
        self.least = int(self.depth.min()) if len(depth) else window

    def matches(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows of this block that occur: document, its word, item and window of each occurrence."""
        none = np.zeros(0, np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        if not len(self.rows) or not sizes.sum():
            return none, none, none, none
        known = self.number.get
        ids = np.fromiter((known(w, 0) for t in texts for w in t), np.int64, int(sizes.sum()))
        ends = np.cumsum(sizes)
        doc = np.repeat(np.arange(len(texts)), sizes)
        # Benchmark words in a row from each position, within the document.
        stop = np.where(ids == 0, np.arange(len(ids)), len(ids))
        stop = np.minimum(np.minimum.accumulate(stop[::-1])[::-1], ends[doc])
        at = np.flatnonzero(stop - np.arange(len(ids)) >= self.least)
        if not len(at):
            return none, none, none, none
        padded = np.append(ids, np.zeros(self.window, np.int64))
        lanes = at[:, None] + np.arange(self.window)
        follow = np.where(lanes < stop[at][:, None], padded[lanes], 0)
        width = 4 * self.window
        suffix = np.ascontiguousarray(follow.astype(">u4")).view(f"S{width}").ravel()
        order = np.argsort(suffix, kind="stable")
        array, place = suffix[order], at[order]
        low_rows = self.rows.astype(">u4")  # pickling may have turned the byte order
        low = low_rows.view(f"S{width}").ravel()
        high_rows = low_rows.copy()
        high_rows[np.arange(self.window) >= self.depth[:, None]] = 0xFFFFFFFF
        high = np.ascontiguousarray(high_rows).view(f"S{width}").ravel()
        first = np.searchsorted(array, low, "left")
        many = np.searchsorted(array, high, "right") - first
        found = np.flatnonzero(many > 0)
        if not len(found):
            return none, none, none, none
        which = np.repeat(found, many[found])
        places = place[np.repeat(first[found], many[found]) + ranges(many[found])]
        starts = (ends - sizes)[doc[places]]
        return doc[places], places - starts, self.owner[which], which


def _found(texts: list[bytes | None], block: Block | None) -> tuple[list[int], list[list[tuple[str, int, int, int]]]]:
    """Word counts, and the verbatim matches (item, place, place in the item, words) of each text."""
    words = [words_of(t) for t in texts]
    out: list[list[tuple[str, int, int, int]]] = [[] for _ in texts]
    if block is not None:
        doc, place, item, which = block.matches(words)
        if len(doc):
            size, offset = block.depth[which], block.offset[which]
            # Windows on one diagonal of a document and an item, at consecutive places, are one match.
            order = np.lexsort((place, place - offset, item, doc))
            doc, place, item, size, offset = doc[order], place[order], item[order], size[order], offset[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1] + 1) | (offset[1:] != offset[:-1] + 1)
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(doc)) - 1
            length = place[last] + size[last] - place[begin]
            for d, i, p, o, n in zip(doc[begin].tolist(), item[begin].tolist(), place[begin].tolist(), offset[begin].tolist(), length.tolist(), strict=True):
                out[d].append((block.items[i], p, o, n))
    return [len(w) for w in words], out


def summary(found: list[tuple[str, int, int, int]]) -> tuple[int, list[str], list[tuple[str, int, int, int]]]:
    """Words hit, item ids and the longest match with each item, from all matches of a text."""
    hit = until = 0
    for p, n in sorted((p, n) for _, p, _, n in found):
        hit += max(0, p + n - max(p, until))
        until = max(until, p + n)
    best: dict[str, tuple[str, int, int, int]] = {}
    for m in sorted(found, key=lambda x: (-x[3], x[1], x[2])):
        best.setdefault(m[0], m)
    return hit, sorted(best), sorted(best.values(), key=lambda x: (-x[3], x[0]))


def stored_blocks(benchmark: DataFrame, window: int, item: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """``number, block`` of the benchmark's blocks as stored rows (an item is never cut), and how many there are."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t")).filter(F.col("t").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("n")).first()["n"]
    blocks = -(-size // block_bytes)
    numbered = items.withColumn("number", F.pmod(F.xxhash64("i", "t"), F.lit(max(1, blocks))).cast("int"))

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        own = list(zip(rows["i"].to_pylist(), as_bytes(rows["t"].combine_chunks()), strict=True))
        return pa.table({"number": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([pickle.dumps(Block(sorted(own), window))], pa.binary())})

    path = scratch_path(spark, "benchmark-blocks")
    numbered.groupBy("number").applyInArrow(build, "number int, block binary").write.parquet(path)
    return spark.read.parquet(path), blocks


def _passes(docs: DataFrame, benchmark: DataFrame, window: int, item: str, item_text: str, block_bytes: int) -> Iterator:
    """One broadcast block after another; each is taken back when the next is asked for."""
    stored, blocks = stored_blocks(benchmark, window, item, item_text, block_bytes)
    context = docs.sparkSession.sparkContext
    for number in range(blocks):
        row = stored.filter(F.col("number") == number).first()
        yield context.broadcast(pickle.loads(row["block"]) if row else None)


FOUND = "array<struct<item_id:string,doc_start:int,item_start:int,n_words:int>>"
_FOUND = pa.list_(pa.struct([("item_id", pa.string()), ("doc_start", pa.int32()), ("item_start", pa.int32()), ("n_words", pa.int32())]))


def _as_found(found: list[list[tuple[str, int, int, int]]]) -> pa.Array:
    return pa.array([[dict(zip(("item_id", "doc_start", "item_start", "n_words"), m, strict=True)) for m in own] for own in found], _FOUND)


def _text_key(text: str) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(7), F.col(text)).alias("_k2")


def _findings(docs: DataFrame, passes: Iterator, window: int, text: str) -> DataFrame:
    """``_k1, _k2, found``: all matches of each text that has any, over all blocks; stored pass by pass."""
    spark = docs.sparkSession
    path = scratch_path(spark, "findings")
    keyed = docs.select(F.col(text).alias("_text"), *_text_key(text)).filter(F.col("_text").isNotNull())

    for shared in passes:

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for b in pieces(batches, "_text", 2 << 20):
                _, found = _found(as_bytes(b.column("_text")), block)
                some = pa.array([bool(x) for x in found], pa.bool_())
                yield pa.RecordBatch.from_arrays([b.column("_k1"), b.column("_k2"), _as_found(found)], ["_k1", "_k2", "found"]).filter(some)

        rows = keyed.mapInArrow(run, f"_k1 long, _k2 long, found {FOUND}")
        rows.dropDuplicates(["_k1", "_k2"]).write.mode("append").parquet(path)  # copies of a text find the same
        shared.destroy()
    return spark.read.parquet(path).groupBy("_k1", "_k2").agg(F.flatten(F.collect_list("found")).alias("found"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, id_: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, n_words, n_hit, items, matches`` of each document.

    ``n_hit``: words inside an occurrence of a window; ``items``: ids of the items with such a window, sorted as strings;
    ``matches``: the longest verbatim match with each of them, with its places (in words) on both sides.
    """
    kind = docs.schema[id_].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_hit long, items array<string>, matches array<{MATCH}>"
    passes = _passes(docs, benchmark, window, item, item_text, block_bytes)
    blocks = [next(passes, None), next(passes, None)]  # no more than two are held, to see whether there is a second one

    def rows_of(ids: pa.Array, sizes: list[int], found: list[list[tuple[str, int, int, int]]]) -> pa.RecordBatch:
        told = [summary(x) if x else (0, [], []) for x in found]
        columns = [ids, pa.array(sizes, pa.int64()), pa.array([t[0] for t in told], pa.int64()), pa.array([t[1] for t in told], pa.list_(pa.string())), _as_found([t[2] for t in told])]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_hit", "items", "matches"])

    if blocks[1] is None:
        shared = blocks[0]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = None if shared is None else shared.value
            for b in pieces(batches, "_text", 2 << 20):
                yield rows_of(b.column("_id"), *_found(as_bytes(b.column("_text")), block))

        return docs.select(F.col(id_).alias("_id"), F.col(text).alias("_text")).mapInArrow(run, schema)

    findings = _findings(docs, chain(blocks, passes), window, text)
    counted = docs.select(F.col(id_).alias("_id"), F.col(text).alias("_text"), *_text_key(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "_text", 2 << 20):
            sizes = [len(words_of(t)) for t in as_bytes(b.column("_text"))]
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_k1"), b.column("_k2"), pa.array(sizes, pa.int64())], ["_id", "_k1", "_k2", "n_words"])

    counted = counted.mapInArrow(count, f"_id {kind}, _k1 long, _k2 long, n_words long").join(findings, ["_k1", "_k2"], "left")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[tuple(m.values()) for m in own or []] for own in b.column("found").to_pylist()]
            yield rows_of(b.column("_id"), b.column("n_words").to_pylist(), found)

    return counted.select("_id", "n_words", "found").mapInArrow(told, schema)


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents without any hit, all columns kept: in one pass, without a join, if the benchmark is one block; else by the texts found in any pass."""
    passes = _passes(docs, benchmark, window, item, item_text, block_bytes)
    blocks = [next(passes, None), next(passes, None)]
    if blocks[1] is None:
        shared = blocks[0]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = None if shared is None else shared.value
            for b in pieces(batches, text, 2 << 20):
                _, found = _found(as_bytes(b.column(b.schema.get_field_index(text))), block)
                yield b.filter(pa.array([not x for x in found], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)
    findings = _findings(docs, chain(blocks, passes), window, text)
    k1, k2 = fresh(docs, "_k1", "_k2")
    keyed = docs.withColumns({k1: F.xxhash64(text), k2: F.xxhash64(F.lit(7), F.col(text))})
    hit = findings.select(F.col("_k1").alias("_hit1"), F.col("_k2").alias("_hit2"))
    return keyed.join(hit, (keyed[k1] == hit["_hit1"]) & (keyed[k2] == hit["_hit2"]), "left_anti").drop(k1, k2)


def items_digest(items: str = "items"):
    """Lower-case hex SHA-256 of the comma-joined ids."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def brute_force(text: str | None, items: list[tuple[object, str | None]], window: int = 10) -> tuple[int, int, str]:
    """n_words, n_hit and the digest by the definition, for tests."""
    words = words_of(None if text is None else text.encode())
    hit, names = set(), []
    for name, body in items:
        own = words_of(None if body is None else body.encode())
        d = min(window, len(own))
        wanted = {tuple(own[j : j + d]) for j in range(len(own) - d + 1)} if own else set()
        found = [p for p in range(len(words) - d + 1) if tuple(words[p : p + d]) in wanted] if wanted else []
        for p in found:
            hit.update(range(p, p + d))
        if found:
            names.append("" if name is None else str(name))
    return len(words), len(hit), hashlib.sha256(",".join(sorted(set(names))).encode()).hexdigest()
