"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one is a minimal perfect hash over the vocabulary: a whole pre-token that is in the vocabulary is
found by two hashes and one comparison. Tier two, for the others, merges bytes held in a doubly linked list,
with the candidate merges in a heap ordered by rank and place. Results of tier two are kept per worker up to a bound.

The vocabulary is a rank file (base64 token, rank per line) whose path is the same on every machine. Texts are split by
the tokenizer's pattern; special tokens aren't looked for. Defined results: null and empty texts have no ids and
decode to an empty text; repeated rows are encoded each by itself.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venturelens.llm.common import kept, pieces
from venturelens.llm.unit_memory import UnitMemory

JOINED = 1 << 17  # remembered unions of two ids
UNIT = regex.compile(r"\s*\S+|\s+")
SPACE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD_TEXT = f"[{SPACE}] [{SPACE}]| $|\x01"  # a space at which a text can't be parted, or one at its end
WORD_THEN_SIGN, SIGN_THEN_WORD = r"([0-9A-Za-z])([!-&(-/:-@\[-`{-~])", r"([!-&(-/:-@\[-`{-~])([0-9A-Za-z])"


class PerfectHash:
    """Minimal perfect hash of byte strings by displaced buckets: n keys on n slots.

    A key's 64-bit hash names its bucket; the bucket's displacement and the other half of the hash give the slot. The
    stored key is compared, so strings outside the set are told apart.
    """

    def __init__(self, keys: list[bytes], values: list[int], load: float = 4.0) -> None:
        n = len(keys)
        self.n, self.buckets = n, max(1, int(n / load))
        self.shift = np.zeros(self.buckets, np.int64)
        self.keys: list[bytes] = [b""] * n
        self.values = [0] * n
        groups: dict[int, list[tuple[int, int]]] = {}
        for i, key in enumerate(keys):
            h = xxhash.xxh64_intdigest(key)
            groups.setdefault((h >> 32) % self.buckets, []).append((h & 0xFFFFFFFF, i))
        free = np.ones(n, bool)
        tries = np.arange(256, dtype=np.int64)
        for bucket in sorted(groups, key=lambda b: (-len(groups[b]), b)):
            rows, base = groups[bucket], 0
            low = np.array([x for x, _ in rows], np.int64)[:, None]
            while True:
                slots = self._slots(low, tries + base)
                good = free[slots].all(0)
                if len(rows) > 1:
                    ordered = np.sort(slots, 0)
                    good &= (ordered[1:] != ordered[:-1]).all(0)
                if good.any():
                    break
                base += len(tries)
            d = int(np.argmax(good))
            self.shift[bucket] = base + d
            for s, (_, i) in zip(slots[:, d].tolist(), rows, strict=True):
                free[s] = False
                self.keys[s], self.values[s] = keys[i], values[i]
        self.displaced = self.shift.tolist()

    def _slot(self, low: int, d: int) -> int:
        mixed = ((low ^ (d * 0x9E3779B1)) * 0x85EBCA6B) & 0xFFFFFFFF
        return ((mixed ^ (mixed >> 15)) * 0xC2B2AE35 & 0xFFFFFFFF) % self.n

    def _slots(self, low: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The same for arrays of 32-bit values, in unsigned 64-bit arithmetic."""
        mixed = ((low ^ (d * 0x9E3779B1)).astype(np.uint64) * np.uint64(0x85EBCA6B)) & np.uint64(0xFFFFFFFF)
        mixed = ((mixed ^ (mixed >> np.uint64(15))) * np.uint64(0xC2B2AE35)) & np.uint64(0xFFFFFFFF)
        return (mixed % np.uint64(self.n)).astype(np.int64)

    def get(self, key: bytes) -> int:
        """The key's value, or -1."""
        h = xxhash.xxh64_intdigest(key)
        s = self._slot(h & 0xFFFFFFFF, self.displaced[(h >> 32) % self.buckets])
        return self.values[s] if self.keys[s] == key else -1


class Codec:
    """One vocabulary with both tiers."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        self.words = [base64.b64decode(a) for a, _ in rows]
        self.ranks = [int(b) for _, b in rows]
        self.table = PerfectHash(self.words, self.ranks)
        self.byte = [self.table.get(bytes([b])) for b in range(256)]
        top = max(self.ranks) + 1
        self.spelled: list[bytes] = [b""] * top
        for word, rank in zip(self.words, self.ranks, strict=True):
            self.spelled[rank] = word
        self.joined: dict[int, int] = {}  # two neighbouring ids -> id of their union, or -1
        self.first = [self.table.get(bytes([a, b])) for a in range(256) for b in range(256)]  # of two bytes
        self.split = regex.compile(pattern)
        self.spelled_array = pa.array(self.spelled, pa.binary())
        self.units = UnitMemory(self._encode_units, 1 << 18)

    def _join(self, key: int) -> int:
        """Id of the union of the two ids in ``key``, or -1; kept in ``joined``."""
        if len(self.joined) >= JOINED:
            self.joined.clear()
        got = self.joined[key] = self.table.get(self.spelled[key >> 20] + self.spelled[key & 0xFFFFF])
        return got

    def merge(self, word: bytes) -> list[int]:
        """Ids of a pre-token that isn't in the vocabulary: lowest rank first, leftmost among equals."""
        ids = [self.byte[b] for b in word]
        n = len(ids)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        known, join, push, pop = self.joined.get, self._join, heapq.heappush, heapq.heappop
        heap = []  # rank << 40 | place
        first = self.first
        for i in range(n - 1):
            rank = first[word[i] << 8 | word[i + 1]]
            if rank >= 0:
                heap.append(rank << 40 | i)
        heapq.heapify(heap)
        while heap:
            top = pop(heap)
            rank, i = top >> 40, top & 0xFFFFFFFFFF
            j = right[i]
            if ids[i] < 0 or j >= n:
                continue
            key = ids[i] << 20 | ids[j]
            if (now := known(key)) is None:
                now = join(key)
            if now != rank:
                continue  # one of the two has been merged since
            ids[i], ids[j] = rank, -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                key = rank << 20 | ids[k]
                if (after := known(key)) is None:
                    after = join(key)
                if after >= 0:
                    push(heap, after << 40 | i)
            h = left[i]
            if h >= 0:
                key = ids[h] << 20 | rank
                if (before := known(key)) is None:
                    before = join(key)
                if before >= 0:
                    push(heap, before << 40 | h)
        return [x for x in ids if x >= 0]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for word in self.split.findall(text):
            raw = word.encode()
            rank = self.table.get(raw)
            if rank >= 0:
                out.append(rank)
            else:
                out += self.merge(raw)
        return out

    def _encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.encode(u[1:].decode("utf-8") if u[:1] == b"\x01" else " " + u.decode("utf-8")) for u in units]
        return np.fromiter(map(len, found), np.int64, len(found)), np.fromiter(chain.from_iterable(found), np.int32)

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text (null: none), unit by unit; equal units of a worker's texts are encoded once.

        The pattern always cuts where white space begins, before a space that a sign follows, and between an ASCII letter or
        digit and an ASCII sign that isn't an apostrophe. So a text may be parted at its spaces, unless white space stands on both
        sides of one, and at those places. A unit's space isn't stored; a unit without one begins with the sign 1.
        """
        texts = pa.compute.fill_null(texts, "")
        odd = pa.compute.match_substring_regex(texts, ODD_TEXT)
        plain = pa.compute.if_else(odd, "", texts)
        for pattern in (WORD_THEN_SIGN, SIGN_THEN_WORD):
            plain = pa.compute.replace_substring_regex(plain, pattern, "\\1 \x01\\2")
        parted = pa.compute.split_pattern(pa.compute.binary_join_element_wise("\x01", plain, ""), " ")
        counts = parted.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        units = parted.flatten()
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(whole):
            lists, at, ends = [], 0, np.cumsum(counts)
            for i in whole.tolist():  # their single empty unit gives way to those between the pattern's own white space
                begin = int(ends[i]) - 1
                own = [u[1:] if u[0] == " " and u[1:2] != "\x01" else "\x01" + u for u in UNIT.findall(texts[i].as_py())]
                lists += [units.slice(at, begin - at), pa.array(own, pa.string())]
                counts[i], at = len(own), int(ends[i])
            units = pa.concat_arrays([*lists, units.slice(at)])
        length, flat = self.units.take(units.cast(pa.binary()))
        before = np.concatenate([[0], np.cumsum(length)])
        starts = before[np.concatenate([[0], np.cumsum(counts)])]
        return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat))

    def decode(self, ids: list[int]) -> bytes:
        spelled = self.spelled
        return b"".join([spelled[i] for i in ids])

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids (null: none)."""
        filled = pa.compute.fill_null(ids.value_lengths(), 0).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(filled)]).astype(np.int32)
        words = self.spelled_array.take(ids.flatten())
        if not len(words):
            return pa.array([b""] * len(ids), pa.binary())
        # The words lie one after another, so a text is a stretch of their bytes.
        ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends[starts]), words.buffers()[2]])


def codec(path: str, pattern: str) -> Codec:
    return kept(("bpe", path, pattern), lambda: Codec(path, pattern))


def encode(docs: DataFrame, ranks: str, pattern: str, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` (array<int>) of each document."""
    kind = docs.schema[id_].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for b in pieces(batches, "_text", 1 << 20):
            yield pa.RecordBatch.from_arrays([b.column("_id"), own.encode_all(b.column("_text"))], ["doc_id", "ids"])

    narrow = docs.select(F.col(id_).alias("_id"), F.col(text).alias("_text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, ranks: str, pattern: str, id_: str = "doc_id", ids: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep`` and ``decoded`` (binary) of each row; null ids decode to an empty text."""
    fields = {f.name: f.dataType.simpleString() for f in encoded.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                b = whole.slice(at, 200)
                yield pa.RecordBatch.from_arrays([b.column("_id"), *(b.column(c) for c in keep), own.decode_all(b.column("_ids"))], ["doc_id", *keep, "decoded"])

    narrow = encoded.select(F.col(id_).alias("_id"), F.col(ids).alias("_ids"), *keep)
    return narrow.mapInArrow(run, ", ".join([f"doc_id {fields[id_]}", *(f"`{c}` {fields[c]}" for c in keep), "decoded binary"]))


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: encoded and decoded again in one pass, for checks of whole collections."""
    kind = docs.schema[id_].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for b in pieces(batches, "_text", 1 << 20):
            ids = own.encode_all(b.column("_text"))
            yield pa.RecordBatch.from_arrays([b.column("_id"), ids, own.decode_all(ids)], ["doc_id", "ids", "decoded"])

    narrow = docs.select(F.col(id_).alias("_id"), F.col(text).alias("_text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")
