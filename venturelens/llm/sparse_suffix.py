"""Repeated passages by sparse suffix arrays.

Suffixes are kept only where they begin at a minimiser: of the ``seed_words``-grams in each window of ``passage`` words the
one with the smallest hash, the leftmost among equals. Equal passages choose equal places, so two passages of ``passage`` words that are
equal always meet at a kept suffix, and about two suffixes in (passage - seed_words) words are kept.

1. The kept suffixes of the whole collection are sorted by their words, block by block of ``seed_words`` words (range partitions; what is
   equal in all blocks is ordered by text and place, so the suffixes of a passage that many texts share are dealt over as many tasks
   as they need). Each is compared with its two neighbours: the longer match is the longest that it has with any other suffix. A suffix
   whose first block matches neither goes; at the borders of partitions the outermost rows are compared afterwards.
2. Each remaining suffix is extended to the left and right: of the windows of ``passage`` words that chose its place, those that need no
   more words to the right than it matches are compared by hash with those of all others. A window found at two places is repeated; its
   first place, in the order of document ids, is the original.
3. Repeated windows that touch are one passage, so matches of any length come out whole.

A text is known by two hashes; exact copies are one class, represented by the smallest id, and only one text of a class goes through the steps.
A passage in a third of the documents becomes one row per task before windows are counted, and the join with its windows can be split.
Windows are compared by 64-bit hashes.

Words are separated by ASCII white space and compared as they are. Defined results: texts that are null, empty or shorter than
``passage`` words have no passage; rows with equal id and text are one document and get equal results; different texts may share an id, which
only labels them; null ids come last in the order, and of texts with equal ids that with the smaller hash comes first; other columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venturelens.llm.common import as_bytes, fresh, pieces, word_hashes
from venturelens.operators.skew import union_rows
from venturelens.session import scratch_path

PASSAGE = 50
SEED_WORDS = 10
BLOCKS = 5  # blocks of a suffix that are compared; what follows may match, too
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

WORD = re.compile(rb"[^\x20\x09-\x0d]+")

def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on; the last n - 1 places are left out."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    whole, have = None, 0
    part, size, power = words, 1, MULTIPLIER
    with np.errstate(over="ignore"):
        left = n
        while left:
            if left & 1:
                # append the block of ``size`` words that follows the ``have`` ones
                shifted = part[have : have + len(words) - n + 1]
                whole = shifted.copy() if whole is None else whole[: len(shifted)] * power + shifted
                have += size
            left >>= 1
            if left:
                part = part[:-size] * power + part[size:]
                size, power = size * 2, power * power
        return mixed(whole)


def window_anchors(words: np.ndarray, sizes: np.ndarray, passage: int, seed_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows within a text, the place of each one's minimiser, and the seed hash of every place."""
    none = np.zeros(0, np.int64)
    seeds = gram_hashes(words, seed_words)
    n = len(words) - passage + 1
    if n <= 0:
        return none, none, seeds
    mask = np.uint64((1 << 24) - 1)
    low = (seeds & ~mask) | (np.arange(len(seeds), dtype=np.uint64) & mask)
    span, width = passage - seed_words + 1, 1
    least = low
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    least = least[:n]
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.arange(n, dtype=np.int64)
    starts = starts[starts + passage <= ends[doc[:n]]]
    place = starts + (((least[starts] & mask).astype(np.int64) - starts) & int(mask))
    return starts, place, seeds


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def following_blocks(seeds: np.ndarray, place: np.ndarray, end: np.ndarray, size: int, blocks: int) -> list[np.ndarray]:
    """Sort keys of the suffixes after the seed: 32 bits of each further block, two in a number; a block beyond the text is like no other."""
    own = mixed(place.astype(np.uint64) ^ mixed(end.astype(np.uint64) + MULTIPLIER))
    parts = []
    for k in range(1, BLOCKS):
        at = place + k * size
        inside = (at + size <= end) & (k < blocks)
        parts.append(np.where(inside, seeds[np.minimum(at, len(seeds) - 1)] if len(seeds) else own, own + np.uint64(k)) >> np.uint64(32))
    return [(parts[i] << np.uint64(32) | parts[i + 1]) for i in (0, 2)]


def suffixes(texts: DataFrame, passage: int, seed_words: int) -> DataFrame:
    """``seed, next, after, h1, h2, place, doc_id``: the kept suffixes of each text (``_id, h1, h2, _text``) with their blocks' hashes.

    Each text also has a row without a seed, which holds its word count as place, and its id. A task gives a text's suffixes once.
    """
    kind = texts.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["seed", "next", "after", "h1", "h2", "place", "doc_id"]
        seen: set[tuple[int, int]] = set()
        for b in pieces(batches, "_text", 2 << 20):
            words, sizes = word_hashes(b.column("_text"))
            ends = np.cumsum(sizes)
            fresh_ = np.ones(len(sizes), bool)
            for i, key in enumerate(zip(b.column("h1").to_pylist(), b.column("h2").to_pylist(), strict=True)):
                fresh_[i] = key not in seen
                seen.add(key)
            _, place, seeds = window_anchors(words, sizes, passage, seed_words)
            place = np.unique(place)
            doc = np.searchsorted(ends, place, side="right")
            place, doc = place[fresh_[doc]], doc[fresh_[doc]]
            rows = pa.array(doc)
            more = following_blocks(seeds, place, ends[doc], seed_words, -(-passage // seed_words))
            columns = [seeds[place], *more]
            here = pa.array((place - (ends - sizes)[doc]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(_signed(c) for c in columns), b.column("h1").take(rows), b.column("h2").take(rows), here, pa.nulls(len(place), b.column("_id").type)], names
            )
            none = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, b.column("h1"), b.column("h2"), pa.array(sizes.astype(np.int32)), b.column("_id")], names)

    return texts.select("_id", "h1", "h2", "_text").mapInArrow(run, f"seed long, next long, after long, h1 long, h2 long, place int, doc_id {kind}")


KEYS = ("seed", "next", "after", "h1", "h2", "place")


def neighbour_matches(a: list[np.ndarray], blocks: int) -> np.ndarray:
    """Blocks that each row of sorted suffixes has in common with the next one."""
    same = a[0][1:] == a[0][:-1]
    matched = same.astype(np.int64)
    for k in range(1, BLOCKS):
        column, shift = a[1 + (k - 1) // 2], 32 * (k % 2)
        part = column >> shift & 0xFFFFFFFF
        same = same & (part[1:] == part[:-1])
        matched += same
    return np.minimum(matched, blocks)


def matched_suffixes(kept: DataFrame, blocks: int) -> DataFrame:
    """``seed, h1, h2, place, matched, border``: the sorted suffixes that match a neighbour, with the number of blocks; and each partition's outermost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before, first = None, 0, True  # the last row, its match with the row before, and whether it is the first of all

        def out(columns: list[np.ndarray], matched: np.ndarray, border: np.ndarray) -> pa.RecordBatch:
            use = (matched > 0) | border
            arrays = [pa.array(columns[i][use]) for i in (0, 3, 4)] + [pa.array(columns[5][use].astype(np.int32)), pa.array(matched[use].astype(np.int32)), pa.array(border[use])]
            return pa.RecordBatch.from_arrays(arrays, ["seed", "h1", "h2", "place", "matched", "border"])

        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in KEYS]
            if held is not None:
                columns = [np.concatenate([[h], c]) for h, c in zip(held, columns, strict=True)]
            new = np.ones(len(columns[0]), bool)  # copies of one text stand side by side
            new[1:] = np.any([c[1:] != c[:-1] for c in columns[3:]], axis=0)
            columns = [c[new] for c in columns]
            between = neighbour_matches(columns, blocks)
            matched = np.maximum(np.concatenate([[before], between]), np.concatenate([between, [0]]))
            border = np.zeros(len(matched), bool)
            border[0] = first
            if len(matched) > 1:
                yield out([c[:-1] for c in columns], matched[:-1], border[:-1])
                before, first = int(between[-1]), False
            held = [c[-1] for c in columns]
        if held is not None:
            yield out([np.array([h]) for h in held], np.array([before]), np.array([True]))

    order = list(KEYS)
    ordered = kept.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, "seed long, h1 long, h2 long, place int, matched int, border boolean")


def candidate_windows(texts: DataFrame, passage: int, seed_words: int) -> DataFrame:
    """``window, text_no, start, again``: windows that chose one of the text's shared ``places`` and need no more words to its right than match.

    A place is stored as 8 * place + matched blocks. ``again``: the same text has the window at a smaller place, too.
    """
    blocks = min(BLOCKS, -(-passage // seed_words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "_text", 2 << 20):
            words, sizes = word_hashes(b.column("_text"))
            starts, place, _ = window_anchors(words, sizes, passage, seed_words)
            begins = np.cumsum(sizes) - sizes
            lists = b.column("places")
            codes = lists.flatten().to_numpy()
            own, matched = np.repeat(begins, lists.value_lengths().to_numpy()) + (codes >> 3), codes & 7
            right = np.zeros(len(words) + 1, np.int64)  # words that may match from the place on
            np.maximum.at(right, own, np.where(matched >= blocks, passage, matched * seed_words + seed_words - 1))
            starts = starts[starts + passage - place <= right[place]]
            hashes = gram_hashes(words, passage)[starts]
            doc = np.searchsorted(begins + sizes, starts, side="right")
            order = np.lexsort((starts, hashes, doc))
            again = np.zeros(len(starts), bool)
            again[order[1:]] = (doc[order[1:]] == doc[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
            yield pa.RecordBatch.from_arrays(
                [_signed(hashes), b.column("text_no").take(pa.array(doc)), pa.array((starts - begins[doc]).astype(np.int32)), pa.array(again)],
                ["window", "text_no", "start", "again"],
            )

    return texts.select("text_no", "_text", "places").mapInArrow(run, "window long, text_no long, start int, again boolean")


def _stored(df: DataFrame, name: str) -> DataFrame:
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def joined_spans(start: np.ndarray, size: np.ndarray, first: np.ndarray, original: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """Touching windows as spans (start, end, row of the first id, original); originals and repeats apart."""
    spans = []
    for kept in (False, True):
        own = np.flatnonzero(original == kept)
        if not len(own):
            continue
        own = own[np.argsort(start[own], kind="stable")]
        s, e = start[own], np.maximum.accumulate(start[own] + size[own])
        cut = np.concatenate([[0], np.flatnonzero(s[1:] > e[:-1]) + 1, [len(own)]])
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            spans.append((int(s[i]), int(e[j - 1]), int(own[i:j][np.argmin(first[own[i:j]])]), kept))
    return sorted(spans, key=lambda x: (x[0], x[1], x[3]))


def _spans(hits: DataFrame) -> DataFrame:
    """``doc_id, h1, h2, spans`` from ``doc_id, h1, h2, hits``."""
    kind = hits.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("hits")
            flat = lists.flatten()
            start, size, first, original = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "size", "first", "original"))
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            found = [[(x, y, i + r, k) for x, y, r, k in joined_spans(start[i:j], size[i:j], first[i:j], original[i:j])] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            rows = [x for f in found for x in f]
            columns = [pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.int32())]
            columns += [flat.field("first_id").take(pa.array([x[2] for x in rows], pa.int64())), pa.array([x[3] for x in rows], pa.bool_())]
            spans = pa.StructArray.from_arrays(columns, ["start", "end", "first_id", "original"])
            at = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h1"), b.column("h2"), pa.ListArray.from_arrays(at, spans)], ["doc_id", "h1", "h2", "spans"])

    return hits.mapInArrow(run, f"doc_id {kind}, h1 long, h2 long, spans array<struct<start:int,end:int,first_id:{kind},original:boolean>>")


def with_hashes(docs: DataFrame, id_: str, text: str) -> DataFrame:
    return docs.select(F.col(id_).alias("_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), F.col(text)).alias("h2"))


def shared_places(kept: DataFrame, blocks: int) -> DataFrame:
    """``h1, h2, places``: the places of each text whose suffix has an equal first block elsewhere, as 8 * place + matched blocks."""
    rows = _stored(matched_suffixes(kept, blocks), "matched-suffixes")
    border = rows.filter("border")  # two rows a partition at most
    at = F.xxhash64("h1", "h2", "place")
    across = border.groupBy("seed").agg(F.min(at).alias("a"), F.max(at).alias("b")).filter("a <> b").select("seed", F.lit(blocks).alias("most"))
    # Beyond a border a suffix may match more than its neighbour inside.
    border = border.join(across, "seed", "left").withColumn("matched", F.coalesce("most", "matched")).filter("matched > 0")
    both = union_rows([rows.filter(~F.col("border")).select("h1", "h2", "place", "matched"), border.select("h1", "h2", "place", "matched")])
    return both.groupBy("h1", "h2").agg(F.collect_set(F.col("place") * 8 + F.col("matched")).alias("places"))


def repeated_passages(docs: DataFrame, id_: str = "doc_id", text: str = "text", passage: int = PASSAGE, seed_words: int = SEED_WORDS) -> DataFrame:
    """``doc_id, h1, h2, spans``: the documents with a repeated passage; ``h1, h2`` are hashes of the text.

    A span counts words from 0, its end excluded. ``first_id`` is the first id of a document that holds a part of it;
    ``original`` tells whether this is the place to keep.
    """
    texts = with_hashes(docs, id_, text).filter(F.col("_text").isNotNull())
    stored = _stored(suffixes(texts, passage, seed_words), "suffixes")
    kept, members = stored.filter("seed is not null").drop("doc_id"), stored.filter("seed is null").select("doc_id", "h1", "h2", "place")
    rows = members.groupBy("h1", "h2", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("n_words"))
    classes = rows.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("first_id"), F.sum("n").alias("copies"), F.max("n_words").alias("n_words"), F.coalesce(F.min_by("n", "doc_id"), F.sum("n")).alias("same")
    )
    places = shared_places(kept, min(BLOCKS, -(-passage // seed_words)))
    # Texts are numbered in the order of ids; the number is the text's name from here on.
    order = [F.asc_nulls_last("first_id"), F.asc("h1"), F.asc("h2")]
    chosen = places.join(classes.select("h1", "h2", "first_id", "same"), ["h1", "h2"]).repartitionByRange(*order).sortWithinPartitions(*order)
    chosen = _stored(chosen.withColumn("text_no", F.monotonically_increasing_id()), "shared-places")
    own = [texts[c] == chosen[c] for c in ("h1", "h2")] + [texts["_id"].eqNullSafe(chosen["first_id"])]
    bodies = texts.join(chosen, own).select("text_no", "same", "_text", "places")
    copied = bodies.filter("same > 1").groupBy("text_no").agg(F.first("_text").alias("_text"), F.first("places").alias("places"))  # rows equal in id and text
    bodies = union_rows([bodies.filter("same = 1").select("text_no", "_text", "places"), copied])
    windows = _stored(candidate_windows(bodies, passage, seed_words), "windows")
    at = F.xxhash64("text_no", "start")
    first = windows.groupBy("window").agg(F.min("text_no").alias("first"), F.min(at).alias("a"), F.max(at).alias("b")).filter("a <> b").select("window", "first")
    first = first.join(chosen.select(F.col("text_no").alias("first"), "first_id"), "first")
    hits = windows.join(first, "window")
    hit = F.struct("start", F.lit(passage).alias("size"), "first", "first_id", ((F.col("text_no") == F.col("first")) & ~F.col("again")).alias("original"))
    of_windows = hits.groupBy("text_no").agg(F.collect_list(hit).alias("hits"))
    of_windows = of_windows.join(chosen.select("text_no", F.col("first_id").alias("doc_id"), "h1", "h2"), "text_no").select("doc_id", "h1", "h2", "hits")
    copies = rows.select("doc_id", "h1", "h2").join(classes.filter((F.col("copies") > 1) & (F.col("n_words") >= passage)), ["h1", "h2"])
    whole = F.struct(F.lit(0).alias("start"), F.col("n_words").alias("size"), F.lit(0).cast("long").alias("first"), "first_id", F.col("doc_id").eqNullSafe(F.col("first_id")).alias("original"))
    of_copies = copies.filter("copies > same").select("doc_id", "h1", "h2", F.array(whole).alias("hits"))
    both = union_rows([of_windows, of_copies]).groupBy("doc_id", "h1", "h2").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    return _spans(both)


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans (and the space between them)."""
    if not spans:
        return text
    places = [(m.start(), m.end()) for m in WORD.finditer(text)]
    out, at = [], 0
    for start, end in spans:
        if start >= len(places):
            break
        begin = places[start][0]
        out.append(text[at:begin])
        at = max(at, places[min(end, len(places)) - 1][1])
    out.append(text[at:])
    return b"".join(out).strip(b" \t\n\x0b\x0c\r")


def cut_repeats(docs: DataFrame, id_: str = "doc_id", text: str = "text", passage: int = PASSAGE, seed_words: int = SEED_WORDS) -> DataFrame:
    """The documents without the repeats of passages: each passage stays at its first place only.

    All columns are kept. A document of which nothing is left goes; documents that had no words before stay as they are.
    """
    spans = repeated_passages(docs, id_, text, passage, seed_words)
    repeats = F.filter("spans", lambda s: ~s["original"])
    names = docs.columns
    key, h1, h2, cut = fresh(docs, "_key", "_h1", "_h2", "_cut")
    theirs = fresh(docs.withColumns({n: F.lit(0) for n in (key, h1, h2, cut)}), "_key2", "_h12", "_h22")
    own = docs.withColumns({key: F.col(id_), h1: F.xxhash64(text), h2: F.xxhash64(F.lit(7), F.col(text))})
    cuts = spans.select(
        *[F.col(c).alias(n) for c, n in zip(("doc_id", "h1", "h2"), theirs, strict=True)], F.transform(repeats, lambda s: F.struct(s["start"], s["end"])).alias(cut)
    ).filter(F.size(cut) > 0)
    joined = own.join(cuts, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip((key, h1, h2), theirs, strict=True)], "left")
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cuts = b.column(len(names)).to_pylist()
            touched = [i for i, c in enumerate(cuts) if c]
            columns = [b.column(i) for i in range(len(names))]
            if touched:
                texts = as_bytes(columns[at])
                for i in touched:
                    texts[i] = cut_words(texts[i], [(c["start"], c["end"]) for c in cuts[i]])
                columns[at] = pa.array([None if t is None else t.decode("utf-8") for t in texts], columns[at].type)
                left = np.ones(len(texts), bool)
                left[[i for i in touched if not texts[i]]] = False
                yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(left))
            else:
                yield pa.RecordBatch.from_arrays(columns, names)

    return joined.select(*[F.col(f"`{n}`") for n in names], cut).mapInArrow(run, docs.schema)


def brute_force(texts: dict[int, str | None], passage: int) -> dict[int, tuple[set[int], set[int]]]:
    """Words of repeated windows by document, repeats and originals apart; for tests (distinct ids)."""
    places: dict[tuple[bytes, ...], list[tuple[int, int]]] = {}
    for d in sorted(texts):
        words = (texts[d] or "").encode().split()
        for i in range(len(words) - passage + 1):
            places.setdefault(tuple(words[i : i + passage]), []).append((d, i))
    out: dict[int, tuple[set[int], set[int]]] = {}
    for found in places.values():
        if len(found) > 1:
            for k, (d, i) in enumerate(sorted(found)):
                out.setdefault(d, (set(), set()))[k == 0].update(range(i, i + passage))
    return out
