"""Runs of periodically repeated words, by internal pattern matching.

A run is a stretch of consecutive words with smallest period q that can't be extended, at least ``exponent`` (4 or more) periods long.
The texts of a batch are searched together:

1. Prefix doubling sorts all suffixes of all texts (texts apart) and on its way names the blocks of 1, 2, 4, … words: equal
   blocks of a text are one stretch of the suffix array.
2. For each size b, blocks are taken at every multiple of b / 2 words. A run with b / 2 < q <= b holds such a block together with what
   follows it for another q words, so the block occurs again within the next b words, and, as no word of length q or more repeats
   inside a run at less than its period, first q words on.
3. That next occurrence is a range successor: the smallest place after the block's own in its stretch of the suffix array, found
   in a wavelet matrix over the array by a count and a quantile, for all blocks at once. The occurrences in the window are in arithmetic
   progression, and their step is the candidate period.
4. Candidates are extended to both sides word by word; what comes out long enough is a run, each found once.

A block that occurs once in its text asks no question, so ordinary text is left after blocks of a few words. Texts stay whole; a task holds
one batch of at most ``pieces``' bytes, or one longer text. There is no shuffle.

Words are separated by ASCII white space and compared as they are. Defined results: null and empty texts have no words and no runs, and
collapse to an empty text; repeated rows each get their own result; an empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venturelens.llm.common import pieces, ranges

RUN = "struct<start:long,length:long,period:long>"
LEAST, EXPONENT = 6, 4
Rewrite = Callable[[object, int], np.ndarray | None]


class WaveletMatrix:
    """Counts and quantiles of ranges of an array of non-negative integers, for arrays of questions."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros_before, self.zeros = [], []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            self.zeros_before.append(np.concatenate([[0], np.cumsum(~one, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(int(self.zeros_before[-1][-1]))
            values = np.concatenate([values[~one], values[one]])

    def count_below(self, low: np.ndarray, high: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Values under ``limit`` in [low, high)."""
        total = np.zeros(len(low), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            before, zeros = self.zeros_before[level], self.zeros[level]
            a, b = before[low], before[high]
            one = (limit >> bit & 1).astype(bool)
            total += np.where(one, b - a, 0)
            low, high = np.where(one, zeros + low - a, a), np.where(one, zeros + high - b, b)
        return np.where(limit >> self.bits > 0, total + high - low, total)  # a limit beyond all values

    def quantile(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value with ``k`` smaller ones before it in [low, high)."""
        value = np.zeros(len(low), np.int64)
        for level, bit in enumerate(range(self.bits - 1, -1, -1)):
            before, zeros = self.zeros_before[level], self.zeros[level]
            a, b = before[low], before[high]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            value |= one.astype(np.int64) << bit
            low, high = np.where(one, zeros + low - a, a), np.where(one, zeros + high - b, b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, after: np.ndarray) -> np.ndarray:
        """The smallest value over ``after`` in [low, high), or -1."""
        k = self.count_below(low, high, after + 1)
        some = k < high - low
        found = np.full(len(low), -1, np.int64)
        found[some] = self.quantile(low[some], high[some], k[some])
        return found


def _ranked(keys: np.ndarray, places: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the order of their keys; the array row at which each one's equals begin, and how many they are.

    ``starts`` are the array rows of the places before; equal ones are one group, and the keys order the groups alike.
    """
    order = np.argsort(keys, kind="stable")
    k, p = keys[order], places[order]
    first = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    own = np.flatnonzero(first)
    size = np.diff(np.append(own, len(k)))
    group = starts[order]
    new_group = np.concatenate([[True], group[1:] != group[:-1]]) if len(k) else np.zeros(0, bool)
    base = np.flatnonzero(new_group)
    within = np.arange(len(k)) - np.repeat(base, np.diff(np.append(base, len(k))))
    row = group + within  # the array row of each place
    return p, np.repeat(row[own], size), np.repeat(size, size)


def candidates(words: np.ndarray, sizes: np.ndarray, exponent: int = EXPONENT) -> tuple[np.ndarray, np.ndarray]:
    """Places and candidate periods: each block's next occurrence, where it is no further than the block is long."""
    n = len(words)
    none = np.zeros(0, np.int64)
    if not n:
        return none, none
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
    end = begin + np.repeat(sizes, sizes)
    longest = int(sizes.max())
    rank = np.full(n + 1, -1, np.int64)  # array row where the names equal to each place's begin
    array = np.arange(n)
    every = np.arange(n)
    # A text's suffixes take the rows of its words, so the first key is the text's begin and the word.
    kinds = int(words.max()) + 1
    p, start, size = _ranked(begin * kinds + words, every, begin)
    asked: list[tuple[np.ndarray, ...]] = []
    b = 1
    while True:
        rank[p], array[start + ranges_of_groups(start)] = start, p
        many = size > 1
        p, start, size = p[many], start[many], size[many]
        step = max(1, b // 2)
        at = (p - begin[p]) % step == 0
        if at.any():
            asked.append((p[at], start[at], size[at], np.full(int(at.sum()), b)))
        # Periods up to 1 / exponent of the longest text are asked for by blocks of up to twice that.
        if not len(p) or b >= longest / exponent:
            break
        follow = p + b
        inside = follow < end[p]
        second = np.where(inside, rank[np.minimum(follow, n - 1)], -1) + 1
        p, start, size = _ranked(start * (n + 2) + second, p, start)
        b *= 2
    if not asked:
        return none, none
    place, low, count, block = (np.concatenate(x) for x in zip(*asked, strict=True))
    # A block that reaches beyond its text isn't one; its name is its own by then, so it was not asked for.
    matrix = WaveletMatrix(array - begin)  # rows of a text hold its own places, counted from its begin
    own = place - begin[place]
    found = matrix.successor(low, low + count, own)
    period = found - own
    good = (found >= 0) & (period <= block) & (2 * period > block)
    return place[good], period[good]


def ranges_of_groups(start: np.ndarray) -> np.ndarray:
    """0, 1, 2, … within each stretch of equal values."""
    if not len(start):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], start[1:] != start[:-1]]))
    return ranges(np.diff(np.append(first, len(start))))


def _equal_words(words: np.ndarray, i: int, j: int, most: int, back: bool) -> int:
    """How many words are equal in a row from i and j on (i < j), or before them; ``most`` at most."""
    have, step = 0, 32
    while have < most:
        take = min(step, most - have)
        x, y = (words[i - have - take : i - have][::-1], words[j - have - take : j - have][::-1]) if back else (words[i + have : i + have + take], words[j + have : j + have + take])
        differ = np.flatnonzero(x != y)
        if len(differ):
            return have + int(differ[0])
        have, step = have + take, step * 4
    return have


def runs_of(words: np.ndarray, sizes: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    place, period = candidates(words, sizes, exponent)
    ends = np.cumsum(sizes)
    doc = np.searchsorted(ends, place, side="right")
    order = np.lexsort((place, period, doc))
    until, last = -1, (-1, -1)  # the stretch of the last period looked at ends there
    for i, q, d in zip(place[order].tolist(), period[order].tolist(), doc[order].tolist(), strict=True):
        if last != (d, q):
            until, last = -1, (d, q)
        if i + q < until:
            continue
        base, end = int(ends[d] - sizes[d]), int(ends[d])
        left = _equal_words(words, i, i + q, i - base, True)
        right = _equal_words(words, i, i + q, end - i - q, False)
        length = left + right + q
        until = i + q + right
        if length >= max(least, exponent * q):
            out[d].append((i - left - base, length, q))
    return [sorted(found, key=lambda r: (r[0], r[2])) for found in out]


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stand in a run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) > 0


def periodic_runs(docs: DataFrame, id_: str = "doc_id", text: str = "text", least: int = LEAST, exponent: int = EXPONENT, rewrite: Rewrite | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of each document: ``collapsed`` are the words that stay, joined by single spaces.

    ``rewrite(id, n)`` may give the numbers of the original words that a text of n words is to consist of instead.
    """
    if exponent < 4:
        raise ValueError("blocks of twice the period are only sure to stand in runs of four periods or more")
    kind = docs.schema[id_].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "_text", 2 << 20):
            split = pa.compute.ascii_split_whitespace(pa.compute.fill_null(b.column("_text"), ""))
            coded = split.flatten().dictionary_encode()
            names = coded.dictionary
            at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            filled = np.asarray(pa.compute.greater(pa.compute.binary_length(names), 0))[at] if len(at) else np.zeros(0, bool)
            before = np.concatenate([[0], np.cumsum(filled)])
            ends = before[np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))])]
            at, sizes = at[filled], np.diff(ends)
            if rewrite is not None:
                for d, key in enumerate(b.column("_id").to_pylist()):
                    if sizes[d] and (order := rewrite(key, int(sizes[d]))) is not None:
                        at[ends[d] : ends[d + 1]] = at[ends[d] + order]
            runs = runs_of(at, sizes, least, exponent)
            keep, left = np.ones(len(at), bool), sizes.copy()
            for d, found in enumerate(runs):
                if found:
                    keep[ends[d] : ends[d + 1]] = ~dropped(int(sizes[d]), found)
                    left[d] = int(keep[ends[d] : ends[d + 1]].sum())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32)), names.take(pa.array(at[keep])))
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in found] for found in runs]
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(sizes), pa.array(rows, run_type), pa.compute.binary_join(lists, " ")], ["doc_id", "n_words", "runs", "collapsed"]
            )

    narrow = docs.select(F.col(id_).alias("_id"), F.col(text).alias("_text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string")


def brute_force(words: list, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """The runs by the definition, for tests."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                stretch = words[i : j + q]
                if not any(all(stretch[k] == stretch[k + p] for k in range(len(stretch) - p)) for p in range(1, q)):
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))
