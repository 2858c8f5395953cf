"""Token counts by finite-state transducers, without building token lists.

Two transducers are compiled from the tokenizer's file:

* the *splitter* (normalised code points -> where a pre-token starts), seven states. A task's texts form one tape;
  the tape is cut into chunks, each chunk is run from every state at once, and the resulting state maps are composed
  by a parallel prefix scan, which gives each chunk its true entry state;
* the *merger* (bytes of a pre-token -> token count). Byte-pair encodings have a local property: a token
  sequence is the encoding of its text when each adjacent pair is the encoding of its own text. So the last token of
  each prefix decides everything, and a state only has to hold, for each place where a vocabulary entry may have begun,
  the trie node reached since, the last token before it and the count there. Each transition carries the change of the
  token count. States are numbered as they are met (the full machine is never built); beyond ``MAX_STATES``
  the numbering starts again, which changes no result.

Defined results: null and empty texts have 0 bytes and 0 tokens; strings of special tokens inside a text count as
one token each, as the library does; repeated rows are counted each by itself.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venturelens.llm.common import as_bytes, kept, pieces

MAX_STATES = 1 << 16
CHUNK = 256  # code points of a tape chunk
LONG = 96  # bytes; longer pre-tokens are walked one by one instead of side by side

# Classes of the splitter's input and its states.
SPACE, LETTER, NUMBER, OTHER, QUOTE, SHORT, R, V, L, E = range(10)
START, WORD, RUN, Q, QR, QV, QL = range(7)
HERE, BEFORE = 1, 2  # emitted: a pre-token starts at this code point; at the one before it


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission by (state, class) for 's 't 're 've 'm 'll 'd | letters | number | other."""
    step, emit = np.zeros((7, 10), np.int8), np.zeros((7, 10), np.int8)
    letters = (LETTER, SHORT, R, V, L, E)
    for state in range(7):
        for c in range(10):
            late = 0
            at = state
            if at in (QR, QV, QL):
                if (at == QL and c == L) or (at in (QR, QV) and c == E):
                    step[state, c] = START
                    continue
                late, at = BEFORE, WORD  # the quote was a pre-token of its own; the letter after it starts a word
            if at == Q:
                if c == SHORT:
                    step[state, c] = START
                    continue
                if c in (R, V, L):
                    step[state, c] = {R: QR, V: QV, L: QL}[c]
                    continue
                at = RUN
            if c == SPACE:
                step[state, c], here = START, 0
            elif c in letters:
                step[state, c], here = WORD, HERE * (at != WORD)
            elif c == NUMBER:
                step[state, c], here = START, HERE
            elif at == RUN:
                step[state, c], here = RUN, 0
            else:
                step[state, c], here = (Q if c == QUOTE else RUN), HERE
            emit[state, c] = here | late
    return step, emit


STEP, EMIT = _splitter()


class Classes:
    """Class of each code point, looked up when first met."""

    def __init__(self) -> None:
        self.table = np.full(0x110000, -1, np.int8)
        for c, kind in {"'": QUOTE, "s": SHORT, "t": SHORT, "m": SHORT, "d": SHORT, "r": R, "v": V, "l": L, "e": E}.items():
            self.table[ord(c)] = kind
        self.kinds = [(regex.compile(p), k) for p, k in ((r"\p{White_Space}", SPACE), (r"\p{L}", LETTER), (r"\p{N}", NUMBER))]

    def of(self, points: np.ndarray) -> np.ndarray:
        got = self.table[points]
        if (got < 0).any():
            for p in np.unique(points[got < 0]):
                c = chr(int(p))
                self.table[p] = next((k for r, k in self.kinds if r.match(c)), OTHER)
            got = self.table[points]
        return got


def compose_maps(maps: np.ndarray) -> np.ndarray:
    """Entry state of each chunk when the tape is entered in state START; ``maps``: (chunks, states) -> state."""
    scanned, shift = maps.copy(), 1
    while shift < len(scanned):  # after each step a row is the map of up to 2 * shift chunks
        scanned[shift:] = np.take_along_axis(scanned[shift:], scanned[:-shift].astype(np.int64), 1)
        shift *= 2
    return np.concatenate([np.array([START], np.int8), scanned[:-1, START]])


def emissions(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """What the splitter emits at each place of the tape."""
    n = len(classes)
    k = -(-n // chunk)
    padded = np.zeros(k * chunk, np.int8)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(k, chunk).T).astype(np.int64)
    flat_step, flat_emit = STEP.ravel(), EMIT.ravel()
    at = np.broadcast_to(np.arange(7, dtype=np.int8), (k, 7))
    for c in columns:
        at = flat_step[at * np.int64(10) + c[:, None]]
    state = compose_maps(np.ascontiguousarray(at))
    out = np.empty((chunk, k), np.int8)
    for i, c in enumerate(columns):
        key = state * np.int64(10) + c
        out[i] = flat_emit[key]
        state = flat_step[key]
    return out.T.ravel()[:n]


def byte_chars() -> list[str]:
    """The character that stands for each byte in byte-level vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Merger:
    """The merger's compiled part. Symbols 0-255 are bytes, 256-511 the last byte of a pre-token."""

    def __init__(self, path: str, end: str = "</w>") -> None:
        with open(path, encoding="utf-8") as f:
            tokenizer = json.load(f)
        model = tokenizer["model"]
        vocab = model["vocab"]
        chars = {c: b for b, c in enumerate(byte_chars())}
        self.special = [t["content"] for t in tokenizer["added_tokens"]]
        self.single = [vocab[c] for c in byte_chars()] + [vocab[c + end] for c in byte_chars()]
        self.merges = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        self.spelled: dict[int, tuple[int, ...]] = {}
        for text, number in vocab.items():
            body, last = (text[: -len(end)], 256) if text.endswith(end) else (text, 0)
            if not body or any(c not in chars for c in body):
                continue
            symbols = [chars[c] for c in body]
            symbols[-1] += last
            self.spelled[number] = tuple(symbols)
        for number, symbols in self.spelled.items():
            node = 0
            for s in symbols:
                if (after := self.children[node].get(s)) is None:
                    after = self.children[node][s] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = after
            self.token[node] = number
        self.whole: dict[int, bool] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.column = np.full(256, -1, np.int32)
        self.columns = 0
        self.states: list[tuple] = [((), -1)]  # (open starts: (node, token before, count there - count here)), last token
        self.number = {self.states[0]: 0}
        self.next = np.full((1024, 32), -1, np.int32)
        self.change = np.zeros((1024, 32), np.int16)
        self.final = np.full((1024, 32), -32768, np.int16)

    def merged(self, tokens: list[int]) -> list[int]:
        """Plain byte-pair merging of short sequences, for compiling."""
        while len(tokens) > 1:
            best = min((self.merges.get(p, (1 << 30, 0)) for p in zip(tokens, tokens[1:], strict=False)))
            if best[0] == 1 << 30:
                break
            out, i = [], 0
            while i < len(tokens):
                if i + 1 < len(tokens) and self.merges.get((tokens[i], tokens[i + 1]), (-1, 0))[0] == best[0]:
                    out.append(best[1])
                    i += 2
                else:
                    out.append(tokens[i])
                    i += 1
            tokens = out
        return tokens

    def follows(self, before: int, token: int) -> bool:
        """Whether ``token`` after ``before`` (-1: the start) is an encoding of their text."""
        if token not in self.whole:
            self.whole[token] = self.merged([self.single[s] for s in self.spelled[token]]) == [token]
        if not self.whole[token] or before < 0:
            return self.whole[token]
        key = (before, token)
        if key not in self.pairs:
            if len(self.pairs) > 1 << 18:
                self.pairs.clear()
            self.pairs[key] = self.merged([self.single[s] for s in self.spelled[before] + self.spelled[token]]) == [before, token]
        return self.pairs[key]

    def moved(self, state: tuple, symbol: int) -> tuple[tuple, int]:
        """State after the symbol, and the change of the token count."""
        starts, last = state
        kept = []
        for node, before, count in (*starts, (0, last, 0)):
            after = self.children[node].get(symbol)
            if after is not None:
                kept.append((after, before, count))
        for node, before, count in kept:  # longest first
            token = self.token[node]
            if token >= 0 and self.follows(before, token):
                change = count + 1
                return (tuple((a, b, c - change) for a, b, c in kept if self.children[a]), token), change
        raise ValueError("the vocabulary lacks a single byte")

    def _room(self, rows: int, columns: int) -> None:
        r, c = self.next.shape
        while r < rows:
            r *= 2
        while c < columns:
            c *= 2
        if (r, c) != self.next.shape:
            for name, empty in (("next", -1), ("change", 0), ("final", -32768)):
                old = getattr(self, name)
                new = np.full((r, c), empty, old.dtype)
                new[: old.shape[0], : old.shape[1]] = old
                setattr(self, name, new)

    def _column(self, byte: int) -> int:
        if self.column[byte] < 0:
            self.column[byte] = self.columns
            self.columns += 1
            self._room(1, self.columns)
        return int(self.column[byte])

    def compile(self, state: int, byte: int) -> None:
        c = self._column(byte)
        after, change = self.moved(self.states[state], byte)
        number = self.number.get(after)
        if number is None:
            number = self.number[after] = len(self.states)
            self.states.append(after)
            self._room(number + 1, 1)
        self.next[state, c] = number
        self.change[state, c] = change

    def compile_final(self, state: int, byte: int) -> None:
        c = self._column(byte)
        self.final[state, c] = self.moved(self.states[state], byte + 256)[1]

    def count_one(self, word: bytes) -> int:
        """One long pre-token."""
        state, total = 0, 0
        for b in word[:-1]:
            c = self.column[b]
            if c < 0 or self.next[state, c] < 0:
                if len(self.states) >= MAX_STATES:
                    held = self.states[state]
                    self.reset()
                    state = self.number.setdefault(held, 1)
                    if state == 1:
                        self.states.append(held)
                self.compile(state, b)
                c = self.column[b]
            total += int(self.change[state, c])
            state = int(self.next[state, c])
        b = word[-1]
        if self.column[b] < 0 or self.final[state, self.column[b]] == -32768:
            self.compile_final(state, b)
        return total + int(self.final[state, self.column[b]])

    def count(self, tape: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token tape[start : start + length], all walked side by side."""
        if len(self.states) >= MAX_STATES:
            self.reset()
        total = np.zeros(len(start), np.int64)
        short = length <= LONG
        for i in np.flatnonzero(~short):
            total[i] = self.count_one(tape[start[i] : start[i] + length[i]].tobytes())
        lanes = np.flatnonzero(short)
        lanes = lanes[np.argsort(-length[lanes].astype(np.int16), kind="stable")]
        begin, size = start[lanes], length[lanes]
        state = np.zeros(len(lanes), np.int64)
        got = np.zeros(len(lanes), np.int64)
        p, ends = 0, np.searchsorted(-size, -np.arange(1, LONG + 2), side="right")  # lanes with size > p
        for b in np.unique(tape):
            self._column(int(b))
        while len(lanes) and p < LONG and ends[p]:
            m, on = int(ends[p]), int(ends[p + 1])
            column = self.column[tape[begin[:m] + p]].astype(np.int64)
            width = self.next.shape[1]
            if m > on:
                key = state[on:m] * width + column[on:]
                value = self.final.ravel()[key]
                if (value == -32768).any():
                    self._fill(key[value == -32768], self.compile_final)
                    value = self.final[state[on:m], column[on:]]
                got[on:m] += value
            if on:
                key = state[:on] * width + column[:on]
                after = self.next.ravel()[key]
                if (after < 0).any():
                    self._fill(key[after < 0], self.compile)
                    after = self.next[state[:on], column[:on]]
                    got[:on] += self.change[state[:on], column[:on]]
                else:
                    got[:on] += self.change.ravel()[key]
                state[:on] = after
            p += 1
        total[lanes] = got
        return total

    def _fill(self, keys: np.ndarray, how) -> None:
        width = self.next.shape[1]
        byte = {int(c): b for b, c in enumerate(self.column) if c >= 0}
        for key in np.unique(keys):
            how(int(key) // width, byte[int(key) % width])


class Counter:
    """Splitter and merger together."""

    def __init__(self, path: str) -> None:
        self.merger = Merger(path)
        self.classes = Classes()
        self.special = re.compile("|".join(map(re.escape, sorted(self.merger.special, key=len, reverse=True))) or r"(?!)")

    def counts(self, texts: list[bytes | None]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        parts, ends, total = [], [], 0
        for i, raw in enumerate(texts):
            text = (raw or b"").decode("utf-8")
            if "<" in text:
                text, found = self.special.subn("\n", text)
                out[i] = found
            if not text.isascii():
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            text = text.lower()
            parts.append(text)
            total += len(text) + 1
            ends.append(total)
        tape = "\n".join(parts) + "\n"
        if total <= len(texts):
            return out
        points = np.frombuffer(tape.encode("utf-32-le"), np.uint32)
        classes = self.classes.of(points)
        emitted = emissions(classes)
        begins = (emitted & HERE) > 0
        begins[:-1] |= (emitted[1:] & BEFORE) > 0
        start = np.flatnonzero(begins)
        if not len(start):
            return out
        stop = np.append(start[1:], len(points))
        spaces = np.flatnonzero(classes == SPACE)
        stop = np.minimum(stop, spaces[np.searchsorted(spaces, start)])
        raw = np.frombuffer(tape.encode("utf-8"), np.uint8)
        if len(raw) == len(points):
            begin, end = start, stop
        else:
            width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            offset = np.concatenate([[0], np.cumsum(width)])
            begin, end = offset[start], offset[stop]
        tokens = self.merger.count(raw, begin, end - begin)
        doc = np.searchsorted(np.array(ends), start, side="right")
        return out + np.bincount(doc, weights=tokens, minlength=len(texts)).astype(np.int64)


def counter(path: str) -> Counter:
    return kept(("counts", path), lambda: Counter(path))


def count_tokens(docs: DataFrame, tokenizer: str, id_: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each document; ``tokenizer`` is the file's path on every machine."""
    kind = docs.schema[id_].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(tokenizer)
        for b in pieces(batches, "_text", 2 << 20):
            texts = as_bytes(b.column("_text"))
            sizes = pa.array([len(t or b"") for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("_id"), sizes, pa.array(machine.counts(texts))], ["doc_id", "n_bytes", "n_tokens"])

    narrow = docs.select(F.col(id_).alias("_id"), F.col(text).alias("_text"))
    counted = narrow.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
