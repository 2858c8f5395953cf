"""What the near-duplicate operator keeps on disk."""

import glob
import os
import random
import time

import pytest

from venturelens import session
from venturelens.llm import id_filter, jaccard


@pytest.fixture
def scratch(tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    return tmp_path


def alike(n=60, base=5, seed=1):
    rng = random.Random(seed)
    texts = [[f"{rng.choice('abcdefgh')}{rng.randrange(40)}" for _ in range(80)] for _ in range(base)]
    out = {}
    for d in range(n):
        words = list(rng.choice(texts))
        for _ in range(rng.choice([0, 1, 2, 6])):
            words[rng.randrange(len(words))] = f"z{rng.randrange(9)}"
        out[d] = " ".join(words)
    return out


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_tables_that_nothing_reads_again_are_gone(spark, scratch):
    docs = spark.createDataFrame(list(alike().items()), "doc_id long, text string")
    got = jaccard.near_duplicates(docs, width=1 << 12)
    left = {name.rpartition("-")[0] for name in os.listdir(scratch)}
    assert "document-keys" in left and left.isdisjoint({"document-sets", "prefix-lists", "marked-lists", "sets", "candidates", "links-0"})
    assert found(got) == jaccard.brute_force(alike(), 5, 80, 100)


def test_shuffles_go_when_their_query_ends(spark, tmp_path):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    shuffles = lambda: {f for top in folders for f in glob.glob(f"{top}/*/shuffle_*")}
    was, setting = shuffles(), spark.conf.get(session.FREE_SHUFFLES)
    table = session.Scratch(spark).store(spark.range(1000).repartition(7, "id"), "moved")
    for _ in range(50):
        if shuffles() <= was:
            break
        time.sleep(0.1)
    assert shuffles() <= was and spark.conf.get(session.FREE_SHUFFLES) == setting and table.count() == 1000


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_wanted_rows_without_a_shuffle_of_texts(spark, few):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(2000)] + [(None, "no id")], "_id long, _text string")
    ids = spark.range(0, 2000, 3).withColumnRenamed("id", "wanted")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on a table with many candidates
    try:
        got = id_filter.among(rows, "_id", ids, few)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
        kept = {r._id for r in got.collect()}
        assert kept >= set(range(0, 2000, 3)) and None not in kept and len(kept) < 700
        rest = id_filter.without(rows, rows["_id"], ids, few).collect()
        assert sorted(r._id for r in rest if r._id is not None) == [i for i in range(2000) if i % 3]
        assert [r._text for r in rest if r._id is None] == ["no id"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_clusters_of_many_blocks_and_many_ids(spark):
    texts = alike(90, 3, 2) | {200 + d: t + " y" for d, t in alike(20, 2, 3).items()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = jaccard.near_duplicates(docs, width=1 << 12, hot=2, block_tokens=400, copies=3, few=0)
    assert found(got) == jaccard.brute_force(texts, 5, 80, 100)
    kept = jaccard.keep_first(docs, width=1 << 12, few=0)
    top = jaccard.brute_force(texts, 5, 80, 100)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d in texts if top[d][1] == d)


def test_a_query_sends_a_block_to_few_others(spark, monkeypatch):
    texts, sent = alike(60, 1, 4), []
    docs = spark.createDataFrame(list(texts.items()), "_id long, _text string")
    clusters = spark.createDataFrame([(d, 0, 76) for d in texts], "id long, component long, n_shingles long")

    class Counting(jaccard.Scratch):
        def store(self, df, name):
            sent.append((name, df))
            return super().store(df, name)

    monkeypatch.setattr(jaccard, "Scratch", Counting)
    want = {d: c for d, (_, c) in jaccard.brute_force(dict(texts), 5, 80, 100).items()}

    def tops(copies):
        top = {d: {d} for d in texts}
        for r in jaccard.cluster_links(clusters, docs, 5, 80, 100, block_tokens=300, copies=copies).collect():
            both = top[r.a] | top[r.b]
            top |= dict.fromkeys(both, both)
        return {d: min(s) for d, s in top.items()}

    assert tops(4) == want
    waves = [name for name, _ in sent if name.startswith("cluster-links")]
    assert len(waves) == 5  # 16 blocks, 0 to 8 steps apart, two steps at a time
    assert tops(99) == want


def test_documents_with_a_common_passage_only_are_no_candidates(spark, monkeypatch):
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = " ".join(word() for _ in range(120))
    rows = [(d, passage + " " + " ".join(word() for _ in range(180))) for d in range(30)]
    counts, real = [], jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda pairs, *a: (counts.append(pairs.count()), real(pairs, *a))[1])
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=1 << 14)
    assert {r.component_id for r in got.collect()} == set(range(30)) and counts[0] == 0


def test_hot_grows_with_the_noise_of_the_sketch(spark):
    assert jaccard.clusters_from(64, 0.0) == jaccard.clusters_from(64, 49.0) == 64
    for noise in (100.0, 400.0, 2000.0):
        assert jaccard.clusters_from(64, noise) > 8 + 8 * noise**0.5
    docs = spark.createDataFrame([("a b c d e f",)], "_text string")
    assert len(jaccard.count_sketch(docs, 3, 20000)) == 20000
