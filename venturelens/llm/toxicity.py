"""Toxic spans and document scores from a linear-chain conditional random field.

Training (in one task, on about ``sample`` toxic and twice as many clean documents at most; the bound is an argument, the model
is all that comes back to the driver):

1. Token labels from document labels: features of words (the word and its beginnings) are chosen greedily,
   always the one that explains most toxic documents not explained yet and is rare in clean ones. A token
   of a toxic document with a chosen feature is labelled toxic.
2. A two-state chain is fitted to the labelled tokens: hashed word features, a transition matrix and a start,
   by gradient ascent on the conditional log-likelihood (forward-backward gives the gradient).
3. The largest marginal of a document (in log-odds) is calibrated to a probability on the same documents. The odds of the
   sample are then replaced by those of all labels outside the held-out fold, so a score doesn't depend on the sample's bound.

Scoring runs over all documents in parallel: forward-backward marginals of each token, aggregated to the
document's score, and the character spans of tokens whose marginal is over one half.

Defined results: null and empty texts, and texts without words, have the lowest log-odds and get their calibrated
score; without training rows of both classes every score is the share of label 1 (0 without rows); repeated rows are scored each by
itself. A document labelled both 0 and 1 is a training row of either class; equal texts with one label are one training row.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venturelens.llm.common import as_bytes, crc32_mod, kept, pieces, ranges

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 20
MEMO = 1 << 17
STEP_WORDS = 1 << 17  # words of the chains that are walked at a time in training
CHAIN = 256  # words; in training, longer texts are several chains, so that they can be walked side by side
SPAN = "struct<start:int,end:int,probability:double>"


def features(word: str) -> list[str]:
    """Of a lower-case word: itself and its first 4 to 6 letters."""
    got = ["w" + word]
    for n in (4, 5, 6):
        if len(word) >= n:
            got.append(f"{n}{word[:n]}")
    return got


def bucket(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature.encode()) % BUCKETS


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Vocabulary:
    """Features of numbered words, held as arrays: ``feature`` numbers (-1 where a word has fewer) and their buckets."""

    def __init__(self, words: list[str]) -> None:
        hashes, self.words = np.zeros((len(words), 4), np.uint64), words
        for i, w in enumerate(words):
            for k, f in enumerate(features(w)):
                hashes[i, k] = xxhash.xxh64_intdigest(f.encode()) | 1
        distinct, number = np.unique(hashes, return_inverse=True)
        skip = int(len(distinct) > 0 and distinct[0] == 0)  # 0 stands for no feature
        self.feature = number.reshape(hashes.shape).astype(np.int32) - skip
        self.size = len(distinct) - skip

    def names(self, wanted: np.ndarray) -> dict[int, str]:
        """The features themselves, for some numbers."""
        rows = np.flatnonzero(np.isin(self.feature, wanted).any(1))
        own = set(wanted.tolist())
        return {n: f for i in rows.tolist() for f, n in zip(features(self.words[i]), self.feature[i].tolist(), strict=False) if n in own}

    def of(self, words: np.ndarray) -> np.ndarray:
        """Numbers of the distinct features of some words."""
        found = np.unique(self.feature[np.unique(words)])
        return found[found >= 0]


def toxic_features(docs: list[np.ndarray], labels: list[int], vocabulary: Vocabulary, least: float = 0.004, ratio: float = 20.0) -> np.ndarray:
    """Greedy cover of the toxic documents by features that are ``ratio`` times as frequent in them as in clean ones; by number."""
    n = [max(1, labels.count(0)), max(1, labels.count(1))]
    clean, toxic = (np.zeros(vocabulary.size, np.int64) for _ in range(2))
    for words, y in zip(docs, labels, strict=True):
        (toxic if y else clean)[vocabulary.of(words)] += 1
    enough = max(3, least * n[1])
    strong = (toxic >= enough) & (toxic / n[1] >= ratio * (clean + 0.5) / n[0])
    sets: dict[int, set[int]] = {f: set() for f in np.flatnonzero(strong).tolist()}
    for i, (words, y) in enumerate(zip(docs, labels, strict=True)):
        if y:
            own = vocabulary.of(words)
            for f in own[strong[own]].tolist():
                sets[f].add(i)
    names = vocabulary.names(np.flatnonzero(strong))
    left, chosen, explained = dict(sets), set(), set()
    while left:
        # Of features with equal gain the longest is the most specific one.
        best = max(left, key=lambda f: (len(left[f]), -clean[f], len(names[f]), names[f]))
        if len(left[best]) < enough:
            break
        chosen.add(best)
        explained |= left.pop(best)
        left = {f: rest for f, s in left.items() if len(rest := s - explained) >= enough}
    # A frequent feature may be explained away by others in the same documents: keep those that are as strong by themselves.
    share = max((toxic[f] for f in chosen), default=0)
    alone = np.flatnonzero((clean == 0) & (toxic >= max(enough, 0.1 * share)))
    return np.union1d(np.array(sorted(chosen), np.int64), alone)


@dataclass
class Model:
    """Weights of the chain; ``start`` and ``move`` are log-potentials of state 1 and of (from, to)."""

    used: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # buckets with a weight
    values: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    bias: float = -8.0
    start: float = 0.0
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    slope: float = 0.0
    offset: float = 0.0
    base: float = 0.0
    fitted: bool = False

    def weights(self) -> np.ndarray:
        """A weight for each bucket."""
        out = np.zeros(BUCKETS, np.float32)
        out[self.used] = self.values
        return out

    def score(self, evidence: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(evidence), self.base)
        return 1 / (1 + np.exp(-np.clip(self.offset + self.slope * evidence, -30, 30)))


LOWEST = -12.0  # log-odds of a document without words; marginals are cut at both ends to this size


def evidence_of(p: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Log-odds of the largest marginal of each document."""
    top = np.zeros(n)
    np.maximum.at(top, doc, p)
    with np.errstate(divide="ignore"):
        return np.clip(np.log(top) - np.log1p(-np.minimum(top, 1 - 1e-9)), LOWEST, -LOWEST)


def forward_backward(emit: np.ndarray, sizes: np.ndarray, start: float, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal of state 1 of each token, and the expected transitions (2, 2) over all chains.

    The chains lie one after another; they are walked side by side, the longest first, in odds of state 1 to state 0.
    """
    n = len(emit)
    p, pair = np.zeros(n), np.zeros((2, 2))
    if not n:
        return p, pair
    order = np.argsort(-sizes, kind="stable")
    begin = (np.cumsum(sizes) - sizes)[order]
    size = sizes[order]
    t = np.exp(move)
    e = np.exp(np.clip(emit, -40, 40))
    ahead, back = np.empty(n), np.ones(n)
    longest = int(size[0])
    live = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")  # chains longer than each place
    r = None
    for i in range(longest):
        at = begin[: live[i]] + i
        if i == 0:
            r = e[at] * np.exp(start)
        else:
            r = r[: live[i]]
            r = e[at] * (t[0, 1] + t[1, 1] * r) / (t[0, 0] + t[1, 0] * r)
        ahead[at] = r
    for i in range(longest - 2, -1, -1):
        m = live[i + 1]
        at = begin[:m] + i
        x = e[at + 1] * back[at + 1]
        back[at] = (t[1, 0] + t[1, 1] * x) / (t[0, 0] + t[0, 1] * x)
    odds = ahead * back
    p = odds / (1 + odds)
    inner = np.ones(n, bool)
    inner[(begin + size - 1)[size > 0]] = False
    i = np.flatnonzero(inner)
    if len(i):
        x = e[i + 1] * back[i + 1]
        a = ahead[i]
        joint = np.stack([np.full(len(i), t[0, 0]), t[0, 1] * x, a * t[1, 0], a * t[1, 1] * x])
        pair = (joint / joint.sum(0)).sum(1).reshape(2, 2)
    return p, pair


def marginals(emit: np.ndarray, flat: np.ndarray, sizes: np.ndarray, start: float, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``forward_backward`` of the words ``flat`` with log-potentials ``emit`` by word, some chains at a time to bound its memory."""
    p, pair = np.zeros(len(flat)), np.zeros((2, 2))
    ends = np.cumsum(sizes)
    at = done = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, done + STEP_WORDS, side="right")))
        until = int(ends[to - 1])
        p[done:until], own = forward_backward(emit[flat[done:until]], sizes[at:to], start, move)
        pair += own
        at, done = to, until
    return p, pair


def fit(texts: list[str], labels: list[int], natural: float | None = None, rounds: int = 40, rate: float = 0.5, penalty: float = 1e-3) -> Model:
    """A model from labelled documents; ``natural`` are the odds of label 1 among all labels (those of ``labels`` if not given)."""
    if not labels or len(set(labels)) < 2:
        return Model(base=float(sum(labels)) / len(labels) if labels else 0.0)
    number: dict[str, int] = {}
    n_docs = len(texts)
    ids = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int32) for t in texts]
    vocabulary = Vocabulary(list(number))
    marked = np.isin(vocabulary.feature, toxic_features(ids, labels, vocabulary)).any(1)
    owner = np.array([i for i, x in enumerate(ids) for _ in range(-(-len(x) // CHAIN))], np.int64)
    ids = [x[k : k + CHAIN] for x in ids for k in range(0, len(x), CHAIN)]
    flat = np.concatenate([x for x in ids if len(x)] or [np.zeros(0, np.int32)])
    sizes = np.array([len(x) for x in ids], np.int64)
    doc = np.repeat(owner.astype(np.int32), sizes)
    truth = marked[flat] & (np.array(labels)[doc] == 1)
    n_words = len(vocabulary.words)
    buckets = np.array([bucket(f) for word in vocabulary.words for f in features(word)], np.int32)
    row = np.repeat(np.arange(n_words), (vocabulary.feature >= 0).sum(1))
    used, column = np.unique(buckets, return_inverse=True)
    del number, vocabulary, ids
    w, bias, start, move = np.zeros(len(used)), -7.0, 0.0, np.zeros((2, 2))
    seen = {k: np.zeros_like(v) for k, v in (("w", w), ("b", np.zeros(1)), ("s", np.zeros(1)), ("m", move))}
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    goal = np.zeros((2, 2))
    follows = np.ones(len(flat), bool)
    follows[first] = False
    j = np.flatnonzero(follows)
    np.add.at(goal, (truth[j - 1].astype(int), truth[j].astype(int)), 1)
    scale = 1.0 / max(1, int(truth.sum()))

    def stepped(key: str, value, gradient):
        seen[key] += np.square(gradient)
        return value + rate * gradient / (np.sqrt(seen[key]) + 1e-8)

    for _ in range(rounds):
        by_word = bias + np.bincount(row, weights=w[column], minlength=n_words)
        p, pair = marginals(by_word, flat, sizes, start, move)
        rest = truth - p
        by_word_rest = np.bincount(flat, weights=rest, minlength=n_words)
        gradient = np.bincount(column, weights=by_word_rest[row], minlength=len(used)) * scale - penalty * w
        w = stepped("w", w, gradient)
        bias = float(stepped("b", np.array([bias]), np.array([rest.sum() * scale]))[0])
        start = float(stepped("s", np.array([start]), np.array([rest[first].sum() * scale]))[0])
        move = stepped("m", move, (goal - pair) * scale - penalty * move)
    model = Model(used.astype(np.int32), w.astype(np.float32), bias, start, move, fitted=True)
    p, _ = marginals(bias + np.bincount(row, weights=w[column], minlength=n_words), flat, sizes, start, move)
    model.slope, model.offset = _calibrated(evidence_of(p, doc, n_docs), np.array(labels, float))
    if natural:
        model.offset += float(np.log(natural * labels.count(0) / labels.count(1)))
    return model


def _calibrated(x: np.ndarray, y: np.ndarray, rounds: int = 50, penalty: float = 1.0) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a small penalty on the slope."""
    beta = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - penalty * np.array([beta[0], 0.0])
        hessian = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag([penalty, 1e-6])
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def training_rows(
    docs: DataFrame, labels: DataFrame, sample: int, folds: int = 4, held_out: int = 2, id_: str = "doc_id", text: str = "text", label: str = "toxic"
) -> tuple[DataFrame, dict[int, int]]:
    """About ``sample`` toxic and twice as many clean texts ``_t, _y`` from outside the held-out fold, chosen by a hash of the id.

    The second result is the number of all labels of each class outside that fold.
    """
    own = labels.select(F.col(id_).alias("_id"), F.col(label).cast("int").alias("_y"))
    own = own.filter(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & (crc32_mod("_id", folds) != held_out)).distinct()
    counts = {r["_y"]: r["count"] for r in own.groupBy("_y").count().collect()}
    span = 1_000_000
    cut = F.lit(0)
    for y, n in counts.items():
        most = sample if y else 2 * sample
        cut = F.when(F.col("_y") == y, F.lit(span if n <= most else int(span * most / n))).otherwise(cut)
    chosen = own.filter(F.pmod(F.xxhash64("_id", F.lit(8)), F.lit(span)) < cut)
    # The chosen ids are about three times ``sample`` rows at most, whatever the size of the tables.
    rows = docs.select(F.col(id_).alias("_id"), F.col(text).alias("_t")).filter(F.col("_t").isNotNull()).join(F.broadcast(chosen), "_id")
    return rows.select("_t", "_y"), counts


def train(docs: DataFrame, labels: DataFrame, sample: int = 1500, **names) -> Model:
    rows, counts = training_rows(docs, labels, sample, **names)
    natural = counts[1] / counts[0] if counts.get(0) and counts.get(1) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("toxicity-training", lambda: None)  # lets go of what other operators left in this worker
        known = sorted({(t, y) for b in batches for t, y in zip(b.column("_t").to_pylist(), b.column("_y").to_pylist(), strict=True)})
        model = fit([t for t, _ in known], [y for _, y in known], natural)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # The sample is bounded, so one task holds it.
    found = rows.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(found["model"]) if found else Model()


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.weights = model.weights()
        self.memo: dict[str, float] = {}

    def emission(self, word: str) -> float:
        return self.model.bias + float(sum(self.weights[bucket(f)] for f in features(word)))

    def emissions(self, words: list[str]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        got = [memo.get(w) for w in words]
        if None in got:
            for i, v in enumerate(got):
                if v is None:
                    w = words[i]
                    if (v := memo.get(w)) is None:
                        v = memo[w] = self.emission(w)
                    got[i] = v
        return np.array(got, np.float64)

    def run(self, texts: list[bytes | None], spans: bool) -> tuple[np.ndarray, list]:
        """Scores and, if asked for, the toxic spans (start, end, probability) in characters."""
        lower = [(t or b"").decode("utf-8").lower() for t in texts]
        found = [WORD.findall(t) for t in lower] if self.model.fitted else [[] for _ in texts]
        sizes = np.array([len(w) for w in found], np.int64)
        emit = np.concatenate([self.emissions(w) for w in found]) if len(found) else np.zeros(0)
        p, _ = forward_backward(emit, sizes, self.model.start, self.model.move)
        doc = np.repeat(np.arange(len(texts)), sizes)
        evidence = evidence_of(p, doc, len(texts))
        out = [[] for _ in texts]
        if spans:
            hot = np.flatnonzero(p > 0.5)
            place = ranges(sizes)
            for d in np.unique(doc[hot]):
                text = texts[d].decode("utf-8")
                lowered = lower[d]
                if len(text) != len(lowered):  # a letter whose lower case is longer: places are those of the lowered text
                    text = lowered
                at = list(WORD.finditer(text.lower()))
                mine = hot[doc[hot] == d]
                for i in mine:
                    word = at[place[i]]
                    previous = out[d][-1] if out[d] else None
                    if previous and not lowered[previous["end"] : word.start()].strip(" "):
                        previous["end"], previous["probability"] = word.end(), max(previous["probability"], float(p[i]))
                    else:
                        out[d].append({"start": word.start(), "end": word.end(), "probability": float(p[i])})
        return self.model.score(evidence), out


class _Shared:
    def __init__(self, context, model: Model) -> None:
        self.broadcast = context.broadcast(model)
        self.id = hash((context.applicationId, id(self.broadcast), float(model.values.sum()), model.offset))

    @property
    def model(self) -> Model:
        return self.broadcast.value


def score_documents(docs: DataFrame, model: Model, id_: str = "doc_id", text: str = "text", spans: bool = True) -> DataFrame:
    """``doc_id, score`` and ``spans`` of each document."""
    shared = _Shared(docs.sparkSession.sparkContext, model)
    kind = docs.schema[id_].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept(("toxicity", shared.id), lambda: Scorer(shared.model))  # words remembered outlive a task
        for b in pieces(batches, "_text"):
            score, found = scorer.run(as_bytes(b.column("_text")), spans)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(score), pa.array(found, span)], ["doc_id", "score", "spans"])

    narrow = docs.select(F.col(id_).alias("_id"), F.col(text).alias("_text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, score double, spans array<{SPAN}>")


def remove_toxic(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The documents that score below ``threshold``, all columns kept."""
    shared = _Shared(docs.sparkSession.sparkContext, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept(("toxicity", shared.id), lambda: Scorer(shared.model))  # words remembered outlive a task
        for b in pieces(batches, text):
            score, _ = scorer.run(as_bytes(b.column(b.schema.get_field_index(text))), False)
            yield b.filter(pa.array(score < threshold))

    return docs.mapInArrow(run, docs.schema)
