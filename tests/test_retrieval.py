import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan_of
from venturelens.operators import retrieval as rt
from venturelens.plans import retrieval as plan


def chunks_by_hand(text, size, overlap, separators):
    """Direct statement of the rules, quadratic: windows over pieces, each as long as possible."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    sep, finer = separators[at], separators[at + 1 :]
    if sep:
        cuts = [i for i in range(len(text)) if text.startswith(sep, i)]
        cuts = [c for n, c in enumerate(cuts) if n == 0 or c >= cuts[n - 1] + len(sep)]
        edges = sorted({0, *cuts, len(text)})
        pieces = [text[a:b] for a, b in zip(edges, edges[1:])]
    else:
        pieces = list(text)
    out, group = [], []

    def pack():
        first = 0
        while first < len(group):
            last = first + 1
            while last < len(group) and sum(map(len, group[first : last + 1])) <= size:
                last += 1
            out.append("".join(group[first:last]).strip())
            if last == len(group):
                break
            start = first
            while start < last and (
                sum(map(len, group[start:last])) > overlap or sum(map(len, group[start : last + 1])) > size
            ):
                start += 1
            first = start
        group.clear()

    for p in pieces:
        if len(p) < size:
            group.append(p)
        else:
            pack()
            out += chunks_by_hand(p, size, overlap, finer) if finer else [p]
    pack()
    return [c for c in out if c]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab. \n", max_size=300), st.integers(5, 40), st.integers(0, 4))
def test_chunks_match_brute_force(text, size, overlap):
    # Overlapping matches of a two-character separator are cut left to right, as in str.split.
    seps = ["\n", ". ", " ", ""]
    got = rt.split_chunks(text, size, overlap, seps)
    assert got == chunks_by_hand(text, size, overlap, seps)
    assert all(0 < len(c) <= size for c in got)
    kept = "".join(got)
    assert set(text.split()) == set() or kept


def test_chunk_edges(spark):
    long_word = "x" * 5000
    got = rt.split_chunks(long_word)
    assert max(map(len, got)) == 800 and got[1][:200] == got[0][-200:]
    assert rt.split_chunks("\n\n\n") == [] and rt.split_chunks("short") == ["short"]
    text = "First part.\n\n" + "word " * 400
    df = spark.createDataFrame([(text,), ("",), (None,)], "text string")
    rows = df.select(rt.recursive_chunks(F.col("text")).alias("c")).collect()
    assert rows[0].c == rt.split_chunks(text) and rows[1].c == [] and rows[2].c == []


def test_window_chunks_cover_the_text(spark):
    texts = ["a" * n for n in (1, 200, 799, 800, 801, 1400, 1401, 5000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", rt.window_chunks(F.col("t")).alias("c")).collect():
        assert row.c[0] + "".join(c[200:] for c in row.c[1:]) == row.t


def store(spark, n=400, dim=8, hot=0.5):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(n):
        company = "hot" if i < n * hot else f"c{i % 5}"
        v = rng.normal(size=dim).round(2)
        rows.append((company, i, [float(x) for x in v], f"text {i % 50}", "s"))
    rows += [(r[0], 10_000 + r[1], r[2], r[3], r[4]) for r in rows[:20]]  # equal vectors
    return spark.createDataFrame(rows, "company string, chunk_key long, embedding array<float>, content string, source string").repartition(7)


def by_hand(chunks, queries, k):
    want = set()
    for q in queries:
        scored = [
            (-round(float(np.dot(np.array(c.embedding, "f8"), np.array(q.embedding, "f8"))), 9), c.chunk_key)
            for c in chunks
            if c.company == q.company
        ]
        want |= {(q.company, q.query_no, key, n) for n, (_, key) in enumerate(sorted(scored)[:k], 1)}
    return want


def queries_of(spark, chunks):
    firsts = {}
    for c in sorted(chunks, key=lambda c: c.chunk_key):
        firsts.setdefault(c.company, []).append(c.embedding)
    rows = [(c, i, v) for c, vs in firsts.items() for i, v in enumerate(vs[:3])]
    return spark.createDataFrame(rows + [("nobody", 0, rows[0][2])], "company string, query_no int, embedding array<float>")


def test_top_k_matches_brute_force_whatever_the_blocks(spark):
    st_ = store(spark)
    chunks = st_.collect()
    queries = queries_of(spark, chunks)
    want = by_hand(chunks, queries.collect(), 4)
    take = lambda df: {(r.company, r.query_no, r.chunk_key, r["rank"]) for r in df.collect()}
    vectors = st_.select("company", "chunk_key", "embedding")
    whole = rt.search_company(vectors, queries, 4)
    assert take(whole) == want
    for chunk_block, query_block in ((7, 1), (50, 2), (10**6, 1)):
        assert take(rt.search_company(vectors, queries, 4, chunk_block=chunk_block, query_block=query_block)) == want
    assert "CartesianProduct" not in plan_of(whole) and "NestedLoop" not in plan_of(whole)


def test_chunks_of_a_hot_company_are_dealt_out_and_no_job_runs_for_the_plan(spark):
    st_ = store(spark).select("company", "chunk_key", "embedding")
    queries = queries_of(spark, st_.collect())
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    df = rt.search_company(st_, queries, 3, chunk_block=10)
    assert len(tracker.getJobIdsForGroup()) == before
    text = plan_of(df)
    assert "_chunk_block" in text and "FlatMapCoGroupsInArrow" in text and "Broadcast" not in text.split("FlatMapCoGroupsInArrow")[0]


def test_no_queries_and_odd_vectors(spark):
    st_ = store(spark).select("company", "chunk_key", "embedding")
    queries = queries_of(spark, st_.withColumn("content", F.lit("")).collect())
    assert rt.search_company(st_, queries.limit(0), 3).count() == 0
    odd = spark.createDataFrame([("hot", -1, [9.0]), ("hot", -2, None), (None, -3, [1.0] * 8), ("hot", -4, [None] + [1.0] * 7)], st_.schema)
    odd_queries = spark.createDataFrame(
        [("hot", 70, [2.0]), ("hot", 71, None), ("hot", 72, [1.0, None]), ("hot", 73, [1.0] * 3), (None, 74, [1.0] * 8)], queries.schema
    )
    for size in (1, 1 << 26):
        rows = rt.search_company(st_.union(odd), queries.union(odd_queries), 3, chunk_block=size, query_block=size).collect()
        assert {(r.query_no, r.chunk_key, r.score) for r in rows if r.chunk_key < 0 or r.query_no >= 70} == {(70, -1, 18.0)}


def test_search_all_is_a_top_k(spark):
    st_ = store(spark)
    q = st_.filter("chunk_key = 3").first().embedding
    df = rt.search_all(st_.select("chunk_key", "embedding"), list(q), 3)
    assert "TakeOrderedAndProject" in plan_of(df)
    scored = [(-round(float(np.dot(np.array(c.embedding, "f8"), np.array(q, "f8"))), 9), c.chunk_key) for c in st_.collect()]
    assert [r.chunk_key for r in df.collect()] == [key for _, key in sorted(scored)[:3]]


def test_window_group_limit_before_the_shuffle(spark):
    plan_text = plan_of(rt.search_company(store(spark), queries_of(spark, store(spark).collect()), 3))
    assert plan_text.count("WindowGroupLimit") == 2


def test_dedupe_keeps_first_and_is_idempotent(spark):
    hits = spark.createDataFrame(
        [("c", "same", 1, 1, 5), ("c", "same", 0, 2, 9), ("c", "other", 0, 1, 7), ("d", "same", 0, 1, 3)],
        "company string, content string, query_no int, rank int, chunk_key int",
    )
    once = rt.dedupe_ordered(hits)
    rows = {(r.company, r.content): (r.query_no, r["rank"], r.chunk_key) for r in once.collect()}
    assert rows == {("c", "same"): (0, 2, 9), ("c", "other"): (0, 1, 7), ("d", "same"): (0, 1, 3)}
    assert {tuple(r) for r in rt.dedupe_ordered(once).collect()} == {tuple(r) for r in once.collect()}


def test_context_without_hits(spark):
    companies = spark.createDataFrame([("a",), ("b",)], "company string")
    hits = spark.createDataFrame([("a", 2, "s2", "two"), ("a", 1, "s1", "one")], "company string, position int, source string, content string")
    got = {r.company: (r.context, r.retrieved_chunks) for r in rt.context_texts(companies, hits).collect()}
    assert got["a"] == ("Source: s1\none\n\n---\n\nSource: s2\ntwo", 2)
    assert got["b"] == (rt.V.NO_CONTEXT, 0)


def test_index_build_and_retrieve(spark):
    random.seed(1)
    words = ["alpha", "beta", "gamma", "delta"]
    files = spark.createDataFrame(
        [(f"c{i % 2}", f"f{i}.txt", f"c{i % 2}/f{i}.txt", " ".join(random.choices(words, k=400))) for i in range(6)] + [("c0", "tiny.txt", "c0/tiny.txt", "tiny")],
        "company string, source string, file_path string, text string",
    )

    def model():
        return lambda texts: [[t.count(w) for w in words] for t in texts]

    index = plan.build_index(files, model).persist()
    assert index.filter("source = 'tiny.txt'").count() == 0
    norms = index.select(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x).alias("n")).collect()
    assert all(abs(r.n - 1) < 1e-5 for r in norms)
    queries = spark.createDataFrame([("c0", 0, [1.0, 0.0, 0.0, 0.0]), ("c1", 0, [0.0, 1.0, 0.0, 0.0])], "company string, query_no int, embedding array<float>")
    hits = plan.retrieve(index, queries, k=2).collect()
    assert len(hits) == 4 and {h.company for h in hits} == {"c0", "c1"}
