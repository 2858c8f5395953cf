"""Near-duplicate documents: an exact Jaccard join on word shingles with adaptive multi-match prefixes.

All shingles are put in one order: rare ones first, by a count sketch of the whole collection, then by hash. Two sets with
similarity t or more share at least l shingles among the first ``n - ceil(t n) + l`` of each, for every l. Each document picks its own
l: a longer prefix is sent to more lists, but fewer documents share l of it, and the estimated cost of both is least at the l
picked. A pair is verified if it shares the smaller l of its two documents, which loses no pair.

1. Exact copies of a set are one class; the class with the smallest id goes on.
2. In each prefix list the smallest id is a hub. A document is verified against the hubs with which it shares most, if that can be enough;
   that links groups of near copies by stars instead of pairs. A pair left out here is met again in steps 3 and 4.
3. Documents that long lists (over ``hot`` documents) connect form clusters: large groups of alike texts, as frequent shingles come last in the order.
   A cluster's sets are compared block by block inside the tasks, by counting over an inverted index; a block returns a spanning forest of its links.
4. Short lists whose documents aren't all in one component by then are joined with themselves, pairs within a component or a cluster left out; what
   shares enough is verified. Steps 3 and 4 together see every pair that shares enough, so components are exact.

The sketch only orders: it has a fixed size, and any order gives the same result. What its noise hides counts as rare, so ``hot`` grows with
the noise: lists that long are still short ones. Sets of candidates are made again from the texts for verification, never gathered; texts
aren't shuffled (``id_filter``). Shingles are compared by 64-bit hashes.

Disk: each step is stored, gives up its shuffles when it ends, and the tables that nothing reads again are deleted. Prefix rows move once.

Words: A-Z are lower-cased, ASCII white space separates. A text with fewer words than a shingle is one shingle; without words
its set is empty and linked with nothing. Defined results: rows with one id are one node of the link graph; rows without id
aren't linked and have no component; repeated rows are copies of each other.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from venturelens.llm.common import fresh, pieces, ranges, word_hashes
from venturelens.llm.graph import components
from venturelens.llm.id_filter import FEW, among, without
from venturelens.llm.sparse_suffix import gram_hashes, mixed
from venturelens.operators.skew import union_rows
from venturelens.session import Scratch, shuffles_freed

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))  # fixed value: A-Z to a-z
SKETCH = 1 << 22  # counters
BLOCK = 1 << 14
VERIFY = 20.0  # cost of a verification in prefix rows
LONGEST = 16  # largest number of matches asked for
HOT = 64  # documents of a list from which on it makes a cluster
CLEAR = 49.0  # documents of a sketch's bucket up to which ``HOT`` of one shingle stand out
BLOCK_TOKENS = 1 << 20  # shingles in a block of a cluster
COPIES = 8  # blocks with which a block of a cluster is compared in one query

def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, sizes = word_hashes(pa.compute.ascii_lower(texts))
    grams = gram_hashes(words, size)
    sets, at = [], 0
    for n in sizes.tolist():
        if n >= size:
            sets.append(np.unique(grams[at : at + n - size + 1]))
        elif n:
            sets.append(gram_hashes(words[at : at + n], n) ^ mixed(np.array([n], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += n
    return sets


def _bucket(tokens: np.ndarray, width: int) -> np.ndarray:
    return (mixed(tokens) % np.uint64(width)).astype(np.int64)


def count_sketch(texts: DataFrame, size: int, width: int = SKETCH) -> np.ndarray:
    """How many documents hold a shingle of each bucket. Summed in the tasks, then by block; ``width`` numbers reach the driver."""
    blocks = -(-width // BLOCK)

    def emit(counts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k, c in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(c.tobytes(), 1)], pa.binary())], ["block", "counts"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(blocks * BLOCK, np.int64)
        for b in pieces(batches, "_text"):
            sets = shingle_sets(b.column("_text"), size)
            if sets:
                np.add.at(total, _bucket(np.concatenate(sets), width), 1)
        yield from emit({k: t for k, t in enumerate(total.reshape(blocks, BLOCK)) if t.any()})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column("block").to_pylist(), b.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(c), np.int64)
                counts[k] = counts[k] + part if k in counts else part
        yield from emit(counts)

    kind = "block int, counts binary"
    with shuffles_freed(texts.sparkSession):
        rows = texts.select("_text").mapInArrow(partial, kind).repartition("block").mapInArrow(merge, kind).collect()
    total = np.zeros(blocks * BLOCK, np.int64)
    for r in rows:
        total[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(zlib.decompress(bytes(r["counts"])), np.int64)
    return np.minimum(total[:width], (1 << 32) - 1).astype(np.uint32)


def needed(n: int, numerator: int, denominator: int) -> int:
    """ceil(t n)"""
    return -(-numerator * n // denominator)


def ordered_prefix(tokens: np.ndarray, counts: np.ndarray, noise: float, numerator: int, denominator: int) -> tuple[np.ndarray, int]:
    """A set's prefix in the common order, and its number of matches."""
    n = len(tokens)
    excess = np.maximum(counts[_bucket(tokens, len(counts))].astype(np.float64) - noise, 0.0)
    # Only clear excess orders: classes by powers of two, then the hash.
    rank = np.where(excess > 8 + 4 * np.sqrt(noise), np.ceil(np.log2(excess + 1)), 0).astype(np.int64)
    order = np.lexsort((mixed(tokens), rank))
    base, top = n - needed(n, numerator, denominator), needed(n, numerator, denominator)
    cost_of = np.cumsum(1.0 + np.where(rank > 0, excess, 0.0)[order])
    matches = np.arange(1, min(LONGEST, top) + 1)
    total = (base + matches) + cost_of[base + matches - 1] * (1.0 + VERIFY * 0.5 ** (matches - 1)) * 0.5
    best = int(matches[np.argmin(total)])
    return tokens[order[: base + best]], best


def clusters_from(hot: int, noise: float) -> int:
    """Documents of a list from which on it makes a cluster, where a sketch's bucket holds ``noise`` documents of other shingles."""
    return math.ceil(hot * max(1.0, math.sqrt(noise / CLEAR)))


def document_sets(texts: DataFrame, size: int, numerator: int, denominator: int, shared: Broadcast, noise: float) -> DataFrame:
    """``doc_id, n_shingles, k1, k2, matches, prefix``: size, class key and prefix of each document (``_id, _text``); ``shared`` are the sketch's counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        names = ["doc_id", "n_shingles", "k1", "k2", "matches", "prefix"]
        for b in pieces(batches, "_text"):
            n, k1, k2, matches, prefix = [], [], [], [], []
            for tokens in shingle_sets(b.column("_text"), size):
                n.append(len(tokens))
                key = xxhash.xxh3_128_intdigest(tokens.tobytes())
                k1.append((key >> 65) & 0x7FFFFFFFFFFFFFFF)
                k2.append(key & 0x7FFFFFFFFFFFFFFF)
                if len(tokens):
                    own, l = ordered_prefix(tokens, table, noise, numerator, denominator)
                else:
                    own, l = tokens, 0
                matches.append(l)
                prefix.append(own.view(np.int64))
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prefix])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefix)))
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(matches, pa.int32()), lists], names
            )

    return texts.select("_id", "_text").mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, matches int, prefix array<bigint>")


def _make_sets(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``id, tokens`` of ``_id, _text``."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "_text"):
            sets = [s.tobytes() for s in shingle_sets(b.column("_text"), size)]
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(sets, pa.binary())], ["id", "tokens"])

    return make


def verified(pairs: DataFrame, texts: DataFrame, size: int, numerator: int, denominator: int, few: int = FEW) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough, stored."""
    scratch = Scratch(texts.sparkSession)
    wanted = scratch.store(union_rows([pairs.select(F.col("a").alias("_id")), pairs.select(F.col("b").alias("_id"))]).distinct(), "candidates")

    sets = among(texts, "_id", wanted, few).select("_id", "_text").mapInArrow(_make_sets(size), "id long, tokens binary")
    sets = scratch.store(sets, "sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([p, q])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(common > 0 and denominator * common >= numerator * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = pairs.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a")
    two = one.join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b")
    found = scratch.store(two.select("a", "b", "x", "y").mapInArrow(check, "a long, b long"), "verified")
    scratch.drop("candidates", "sets")
    return found


def _sizes_fit(a: Column, b: Column, numerator: int, denominator: int) -> Column:
    return F.lit(denominator) * F.least(a, b) >= F.lit(numerator) * F.greatest(a, b)


def block_links(tokens: list[np.ndarray], ids: np.ndarray, blocks: np.ndarray, numerator: int, denominator: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks (0 and 1), or within one if all are of block 0."""
    sizes = np.array([len(t) for t in tokens], np.int64)
    flat, owner = np.concatenate(tokens), np.repeat(np.arange(len(tokens)), sizes)
    order = np.argsort(flat, kind="stable")
    owner, first = owner[order], np.ones(len(flat), bool)
    first[1:] = flat[order[1:]] != flat[order[:-1]]
    begin = np.flatnonzero(first)
    length = np.diff(np.append(begin, len(flat)))
    number = np.empty(len(flat), np.int64)  # list of each token of each set
    number[order] = np.cumsum(first) - 1
    top = list(range(len(tokens)))

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    one = not (blocks == 1).any()
    at, found = 0, []
    for a in range(len(tokens)):
        lists = number[at : at + sizes[a]]
        at += sizes[a]
        if blocks[a] != 0:
            continue
        lists = lists[length[lists] > 1]
        if not len(lists):
            continue
        count = length[lists]
        others = owner[np.repeat(begin[lists], count) + ranges(count)]
        common = np.bincount(others, minlength=len(tokens))
        good = (common > 0) & (denominator * common >= numerator * (sizes + sizes[a] - common))
        good &= np.arange(len(tokens)) > a if one else blocks == 1
        for b in np.flatnonzero(good).tolist():
            x, y = find(a), find(b)
            if x != y:
                top[y] = x
                found.append((int(ids[a]), int(ids[b])))
    return found


def cluster_links(clusters: DataFrame, texts: DataFrame, size: int, numerator: int, denominator: int, block_tokens: int = BLOCK_TOKENS, few: int = FEW, copies: int = COPIES) -> DataFrame:
    """Links ``a, b`` (a spanning forest per pair of blocks) within clusters ``id, component, n_shingles``.

    Each pair of blocks meets, but a query sends a block to ``copies`` others only, nearest (in a ring) first, so disk doesn't grow with the number of blocks.
    """
    scratch = Scratch(texts.sparkSession)
    whole = clusters.groupBy("component").agg(F.ceil(F.sum("n_shingles") / block_tokens).cast("int").alias("blocks"))
    placed = clusters.join(whole, "component").select("id", "component", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"))
    placed = scratch.store(placed, "clusters")
    own = among(texts, "_id", placed.select("id"), few)
    sets = own.select("_id", "_text").mapInArrow(_make_sets(size), "id long, tokens binary").join(placed, "id")
    most = placed.agg(F.max("blocks")).first()[0] or 1
    apart = F.abs(F.col("block") - F.col("other"))
    every = sets if most <= copies else scratch.store(sets, "cluster-sets")

    def link(table: pa.Table) -> pa.Table:
        tokens = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
        ids, side = table.column("id").to_numpy(), table.column("side").to_numpy()
        found = block_links(tokens, ids, side, numerator, denominator)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    def compared(steps: range) -> DataFrame:
        """The links between blocks that are as many steps apart in the ring of their cluster's blocks."""
        paired = every.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        paired = paired.filter(F.least(apart, F.col("blocks") - apart).between(steps[0], steps[-1])).select(
            "id", "tokens", "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side")
        )
        return paired.groupBy("component", "i", "j").applyInArrow(link, "a long, b long")

    if most <= copies:
        return compared(range(most))
    wide = max(1, copies // 2)  # a step leads to a block on either side
    found = [scratch.store(compared(range(k, min(k + wide, most // 2 + 1))), f"cluster-links-{k}") for k in range(0, most // 2 + 1, wide)]
    scratch.drop("cluster-sets")
    return union_rows(found)


def near_duplicates(
    docs: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    size: int = 5,
    numerator: int = 80,
    denominator: int = 100,
    hubs: int = 2,
    width: int = SKETCH,
    hot: int = HOT,
    block_tokens: int = BLOCK_TOKENS,
    few: int = FEW,
    copies: int = COPIES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row: documents link at a similarity of ``numerator / denominator`` or more."""
    texts = docs.select(F.col(id_).cast("long").alias("_id"), F.col(text).alias("_text"))
    spark = docs.sparkSession
    scratch = Scratch(spark)
    counts = count_sketch(texts, size, width)
    noise = float(np.median(counts)) if len(counts) else 0.0
    hot = clusters_from(hot, noise)
    shared = spark.sparkContext.broadcast(counts)
    stored = scratch.store(document_sets(texts, size, numerator, denominator, shared, noise), "document-sets")
    shared.destroy()
    narrow = scratch.store(stored.drop("prefix"), "document-keys")
    key = ["k1", "k2", "n_shingles"]
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    classes = narrow.filter(linked).groupBy(*key).agg(F.min("doc_id").alias("first_id"))
    # An id may stand for several sets; each is a class of its own here, and one node of the graph.
    chosen = stored.filter(linked).join(classes, key).filter("doc_id = first_id")
    rows = chosen.select("doc_id", "n_shingles", "matches", F.posexplode("prefix").alias("place", "token"))
    of_token = Window.partitionBy("token")
    lists = rows.withColumns({"hub": F.min("doc_id").over(of_token), "last": F.max("doc_id").over(of_token), "n_docs": F.count(F.lit(1)).over(of_token)})
    prefix = scratch.store(lists.filter("hub <> last").drop("last"), "prefix-lists")
    scratch.drop("document-sets")
    # Shingles of a set after its prefix. Two sets share at most the larger of their rests beyond what their prefixes share.
    rest = F.ceil(F.col("n_shingles") * numerator / denominator) - F.col("matches")
    about = narrow.filter(linked).groupBy("doc_id").agg(
        F.min("n_shingles").alias("hub_min"), F.max("n_shingles").alias("hub_max"), F.min("matches").alias("hub_matches"), F.max(rest).alias("hub_rest")
    )
    star = prefix.filter("doc_id <> hub").groupBy("doc_id", "hub", "n_shingles", "matches").agg(F.count(F.lit(1)).alias("shared"))
    star = star.join(about.withColumnRenamed("doc_id", "hub"), "hub").filter(
        (F.col("shared") >= F.least("matches", "hub_matches"))
        & (F.lit(denominator) * F.col("n_shingles") >= F.lit(numerator) * F.col("hub_min"))
        & (F.lit(denominator) * F.col("hub_max") >= F.lit(numerator) * F.col("n_shingles"))
        & (F.lit(numerator + denominator) * (F.col("shared") + F.greatest(rest, "hub_rest")) >= F.lit(numerator) * (F.col("n_shingles") + F.col("hub_min")))
    )
    best = Window.partitionBy("doc_id").orderBy(F.desc("shared"), "hub")
    first_pairs = scratch.store(star.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= hubs).select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct(), "star-pairs")
    links = verified(first_pairs, texts, size, numerator, denominator, few)
    # Long lists: clusters, compared in blocks.
    long_ = prefix.filter(F.col("n_docs") > hot).select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
    clusters = components(long_).join(about.select(F.col("doc_id").alias("id"), F.col("hub_max").alias("n_shingles")), "id")
    clusters = scratch.store(clusters, "cluster-members")
    dense = cluster_links(clusters, texts, size, numerator, denominator, block_tokens, few, copies)
    stars = scratch.store(components(union_rows([links, dense])), "first-components")
    # Short lists with documents of several components, and the pairs across.
    marked = prefix.filter(F.col("n_docs") <= hot).drop("hub", "n_docs").join(stars.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    marked = marked.join(clusters.select(F.col("id").alias("doc_id"), F.col("component").alias("cluster")), "doc_id", "left")
    marked = scratch.store(marked.withColumn("rest", rest), "marked-lists")
    scratch.drop("prefix-lists")
    open_ = (
        marked.groupBy("token")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .filter("lo <> hi")
        .select("token")
    )
    left = marked.join(open_, "token", "left_semi")
    carried = ("doc_id", "n_shingles", "matches", "place", "component", "cluster", "rest")
    a = left.select("token", *[F.col(c).alias(f"{c}_a") for c in carried])
    b = left.select("token", *[F.col(c).alias(f"{c}_b") for c in carried])
    n_a, n_b, p_a, p_b = (F.col(c) for c in ("n_shingles_a", "n_shingles_b", "place_a", "place_b"))
    # What can still be shared: the places before on both sides, this one, and the places after.
    most = F.least(p_a, p_b) + F.least(n_a - p_a, n_b - p_b)
    across = a.join(b, "token").filter(
        (F.col("component_a") < F.col("component_b"))
        & ~F.coalesce(F.col("cluster_a") == F.col("cluster_b"), F.lit(False))
        & _sizes_fit(n_a, n_b, numerator, denominator)
        & (F.lit(numerator + denominator) * most >= F.lit(numerator) * (n_a + n_b))
    )
    pairs = across.groupBy("doc_id_a", "doc_id_b", "n_shingles_a", "n_shingles_b").agg(
        F.count(F.lit(1)).alias("shared"), F.min(F.least("matches_a", "matches_b")).alias("least"), F.max(F.greatest("rest_a", "rest_b")).alias("rest")
    )
    enough = F.lit(numerator + denominator) * (F.col("shared") + F.col("rest")) >= F.lit(numerator) * (n_a + n_b)
    pairs = pairs.filter((F.col("shared") >= F.col("least")) & enough)
    pairs = pairs.select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")).distinct()
    pairs = scratch.store(pairs.join(first_pairs, ["a", "b"], "left_anti"), "cross-pairs")
    scratch.drop("marked-lists")
    more = verified(pairs, texts, size, numerator, denominator, few)
    # Ids with several sets link their classes: the id itself is the node.
    of_classes = narrow.filter(linked).join(classes, key).select(F.col("first_id").alias("a"), F.col("doc_id").alias("b")).filter("a <> b")
    found = components(union_rows([stars.select(F.col("component").alias("a"), F.col("id").alias("b")), more, of_classes]))
    out = narrow.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, id_: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest id; all columns kept.

    Documents without words stay. Where ids aren't unique whole numbers, rows are numbered in the order of id (null ids last), hash of the
    text and reading, and that number stands for the row: unrelated texts with one id stay, equal rows are copies.
    """
    other, row = fresh(docs, "_dropped", "_row")
    scratch = Scratch(docs.sparkSession)
    named = id_
    odd = F.col(id_).isNull() | (F.col("count") > 1)
    if not isinstance(docs.schema[id_].dataType, IntegralType) or docs.groupBy(id_).count().filter(odd).take(1):
        order = [F.asc_nulls_last(id_), F.xxhash64(text)]
        docs = scratch.store(docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(row, F.monotonically_increasing_id()), "numbered-rows")
        named = row
    found = near_duplicates(docs, named, text, **options)
    dropped = found.filter((F.col("n_shingles") > 0) & (F.col("component_id") < F.col("doc_id"))).select(F.col("doc_id").alias(other)).distinct()
    dropped = scratch.store(dropped, "near-copies")
    return without(docs, F.col(named).cast("long"), dropped, options.get("few", FEW)).drop(row)


def brute_force(texts: dict[int, str | None], size: int, numerator: int, denominator: int) -> dict[int, tuple[int, int]]:
    """n_shingles and component of each id by the definition, for tests."""
    sets = {}
    for d, t in texts.items():
        words = (t or "").encode().translate(LOWER).split()
        k = min(size, len(words))
        sets[d] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()
    top = {d: d for d in texts}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and denominator * common >= numerator * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}
