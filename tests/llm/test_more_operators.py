"""Periodic runs, I-Match fingerprints and importance resampling against the definition, and on odd input."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from venturelens.llm import imatch, periodic_runs, resampling

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


# 11: periodic runs


def periodic_texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        kinds, length = rng.choice([1, 2, 3, 10]), rng.choice([0, 1, 5, 20, 60, 130])
        words = [rng.randrange(kinds) for _ in range(length)]
        for _ in range(rng.randint(0, 3) if length > 4 else 0):
            a = rng.randrange(length)
            p = rng.randint(1, length // 4)
            for i in range(a, min(length, a + p * rng.randint(2, 6) + rng.randint(0, p))):
                words[i] = words[a + (i - a) % p]
        yield words


def test_runs_by_definition():
    texts = list(periodic_texts(3, 1500))
    for at in range(0, len(texts), 6):
        own = texts[at : at + 6]
        got = periodic_runs.runs_of(np.array([x for t in own for x in t], np.int64), np.array([len(t) for t in own]))
        assert got == [periodic_runs.brute_force(t) for t in own]


def test_wavelet_successor():
    rng = np.random.default_rng(1)
    values = rng.permutation(300)
    matrix = periodic_runs.WaveletMatrix(values)
    low = rng.integers(0, 300, 500)
    high, after = low + rng.integers(0, 301 - low), rng.integers(-1, 320, 500)
    for i, j, x, got in zip(low, high, after, matrix.successor(low, high, after), strict=True):
        assert got == min((v for v in values[i:j] if v > x), default=-1)


def test_runs_query(spark, sf):
    rows = {r["doc_id"]: r for r in entry.queries()["op11_periodic_runs"](spark, sf).collect()}
    checked = 0
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words, h = (d.text or "").encode().split(), zlib.crc32(str(d.doc_id).encode())
        n, g = len(words), h // 10
        if n > 700:
            continue
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = periodic_runs.brute_force(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        drop = {i for s, length, q in runs for i in range(s + q, s + length)}
        expected = (d.doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4))
        assert tuple(rows[d.doc_id])[:6] == expected
        assert rows[d.doc_id].runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert rows[d.doc_id].collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest()
        checked += len(runs)
    assert checked > 10


def test_runs_odd(spark, odd_docs, no_docs):
    found = periodic_runs.periodic_runs(odd_docs)
    assert found.count() == 12 and periodic_runs.periodic_runs(no_docs).count() == 0
    long_text = "start " + "la la la la di " * 50000 + "end"
    rows = [(1, long_text), (1, long_text), (None, "x x x x x x x"), (2, None), (3, " \n")]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs][:1], r.collapsed) for r in periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(1, 250002, [(1, 250000, 5)], "start la la la la di end")] * 2 + [(None, 7, [(0, 7, 1)], "x"), (2, 0, [], ""), (3, 0, [], "")], key=repr)


# 12: I-Match


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def spark_hash(*values):
    seed = 42
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else int(v[0]).to_bytes(v[1], "little", signed=True), seed)
    return signed(seed)


def slow_signatures(terms, words, parts):
    terms = sorted(t for t in terms if t in words)
    n = len(terms)
    level = next(k for k in range(40) if 4**k >= n)
    hashed = lambda x: spark_hash(*((t, 8) for t in x))
    part = lambda j, k: [t for t in terms if spark_hash((t, 8), (j, 4)) & (4**k - 1) == 0]
    listed = lambda k: [hashed(x) & 0x7FFFFFFF | 1 if (x := part(j, k)) else 0 for j in range(1, parts + 1)]
    return n, level, hashed(terms), listed(level), listed(level + 1)


def slow_imatch(docs, parts, least, most):
    """By the definition, for distinct ids."""
    terms = lambda t: {spark_hash(w) for w in re.findall(r"[^\W_]+", t.lower())}
    docs = sorted(((d, t or "") for d, t in docs), reverse=True)
    counts = {}
    for _, t in docs:
        for w in terms(t):
            counts[w] = counts.get(w, 0) + 1
    words = {w for w, n in counts.items() if least * len(docs) <= n <= most * len(docs)}

    def sign(t):
        n, level, whole, here, above = slow_signatures(terms(t), words, parts)
        return n, level, whole if n else spark_hash(*((x, 8) for x in sorted(terms(t)))), here, above

    def near(a, b):
        if a[0] == b[0] and a[2] == b[2]:
            return 1.0
        x, y = {0: (a[3], b[3]), 1: (a[4], b[3]), -1: (a[3], b[4])}.get(b[1] - a[1], ([], []))
        held = sum(1 for i, j in zip(x, y, strict=True) if i or j)
        return sum(1 for i, j in zip(x, y, strict=True) if i and i == j) / held if held else 0.0

    text = lambda s: ":".join([str(s[0]), str(s[1]), f"{s[2] & (1 << 64) - 1:X}", *(",".join(f"{v:X}" for v in x) for x in s[3:])])
    out = {}
    for i, (d, t) in enumerate(docs):
        after = docs[(i + 1) % len(docs)][1]
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        a, b = sign(t), sign(changed)
        out[d] = (len(t), hashlib.sha256(changed.encode()).hexdigest(), text(a), text(b), near(a, b), near(a, sign(after)))
    return out


def test_imatch_by_definition(spark, small):
    docs = small.filter(F.coalesce(F.length("text"), F.lit(0)) < 4000)
    got = {r.doc_id: tuple(r)[1:] for r in imatch.fingerprints(docs, parts=6, least=0.02).collect()}
    expected = slow_imatch([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 6, 0.02, imatch.MOST_SHARE)
    # Spark's letters and digits are Java's; words with other signs may be cut elsewhere.
    assert got.keys() == expected.keys()
    assert all(got[d][:2] == expected[d][:2] for d in got)
    assert sum(got[d] != expected[d] for d in got) == 0


def test_imatch_tells_edited_from_next(spark, small):
    rows = imatch.fingerprints(small).collect()
    assert np.mean([r.near_edited for r in rows]) > 0.15 > 0.05 > np.mean([r.near_next for r in rows])


def test_imatch_odd(spark, odd_docs, no_docs):
    rows = imatch.fingerprints(odd_docs).collect()
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    assert len(rows) == 12 and imatch.fingerprints(no_docs).count() == 0
    by_text = {}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and r.n_chars == len(texts[r.doc_id])
        by_text.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert sorted(r.near_next for r in rows if r.doc_id == 6)[-1] == 1.0  # the first copy is followed by the second
    one = imatch.fingerprints(spark.createDataFrame([(None, "abcd", None, None, None)], SCHEMA)).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def test_imatch_plan_is_native(spark, sf):
    from tests.conftest import plan_of

    plan = plan_of(entry.queries()["op12_imatch"](spark, sf))
    assert not any(x in plan for x in ("Python", "Arrow", "ExternalRDD"))


# 13: importance resampling


@pytest.mark.parametrize("orders", [(1, 1), (1, 2)])
def test_resampling_by_definition(spark, sf, small, orders):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    texts = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    expected = resampling.brute_force(texts, [r.text for r in benchmark.collect()], 5, (30, 100), 20, orders, 1000)
    got = resampling.resample(small, benchmark, seed=5, share=(30, 100), orders=orders, buckets=1000, error=0.01)
    assert sorted(map(tuple, got.drop("n_words").collect())) == sorted(expected)


@pytest.mark.parametrize("error", [0.0005, 0.2])
@pytest.mark.parametrize("draws", [1, 499, 500, 501, 1000])
def test_cutoff_among_ties(spark, error, draws):
    rows = spark.range(1000).select(F.col("id").alias("row"), (1000 - F.col("id")).alias("doc_id"), F.when(F.col("id") < 500, F.lit(7)).otherwise(F.col("id") % 5).cast("long").alias("score"))
    order = sorted(((r.score, r.doc_id, r.row) for r in rows.collect()), key=lambda r: (-r[0], r[1], r[2]))
    assert resampling.cutoff(rows, draws, 1000, error) == order[draws - 1]


def test_resampling_odd(spark, odd_docs, no_docs):
    rows = resampling.resample(odd_docs, no_docs, seed=1, share=(1, 2), least_words=1).collect()
    assert len(rows) == 12
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 1 + sum(r.n_words > 0 for r in rows) // 2))
    assert {(r.n_features, r.weight) for r in rows if r.doc_id in (1, 2, 3)} == {(0, 0)}
    assert resampling.resample(no_docs, odd_docs, seed=1).count() == 0
    same = spark.createDataFrame([(None, "a b c")] * 40 + [(1, "a b c")] * 40, "doc_id long, text string")
    rows = resampling.resample(same, same, seed=1, share=(1, 4), least_words=1).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 21))
