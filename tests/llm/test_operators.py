"""Each operator against the definition, the library or a round trip, and on odd input."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from venturelens.llm import bpe, decontaminate, graph, jaccard, langid, orc_tokens, quality, sparse_suffix, token_counts, toxicity, warc
from venturelens.session import scratch_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


# 1: host quality


def slow_measures(text):
    words = (text or "").encode().split()
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) for k in range(3) if grams[tuple(words[i : i + 3])] > 1}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            again += line in seen
            seen.add(line)
    return len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), again, len(hit)


def test_measures(spark, small, odd_docs):
    for docs in (small, odd_docs):
        got = sorted((tuple(r)[2:] for r in quality.measure(docs).collect()), key=repr)
        assert got == sorted((slow_measures(r.text) for r in docs.select("text").collect()), key=repr)


def test_host_rates_shrink(spark):
    rows = [("big", 1)] * 90 + [("big", 0)] * 10 + [("tiny", 1)] + [(f"h{i}", 0) for i in range(50) for _ in range(20)]
    df = spark.createDataFrame(rows, "host string, k int").select("host", F.array("k").alias("fails"))
    rates = {r["host"]: r["rate_r"] for r in quality.host_rates(df, {"r": "true"}).collect()}
    assert 0.8 < rates["big"] < 0.9 and rates["h0"] < 0.05 and rates["tiny"] < 0.6


def test_bad_host_goes_and_clean_stays(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, good + f" {i}", "en", "fine", 0) for i in range(30)] + [(100 + i, "short", "en", "bad", 0) for i in range(30)] + [(200, good, "en", "bad", 0)]
    kept = by_id(quality.host_quality(spark.createDataFrame(rows, SCHEMA)), "kept", "host_rejected")
    assert all(kept[i] == (True, False) for i in range(30)) and kept[200] == (False, True)


def test_quality_odd(odd_docs, no_docs):
    assert quality.host_quality(odd_docs).count() == 12
    assert quality.host_quality(no_docs).count() == 0


# 2: WARC


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_warc_round_trip(spark, broadcast_rows):
    big = "x" * 120
    rows = [
        (1, "http://a b\r\nc%41", big), (2, None, big), (2, "u", big), (3, "é", None), (4, "u", "short"), (5, "u", "short"), (None, "n", big),
        (6, "u", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5), (7, "u", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5), (8, "u", big + "\r\n\r\n"),
        (9, "u", "\r\n\r\n" + big), (10, "u", "é" * 60 + "\x85\x00z"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).repartition(2)
    raw, new = scratch_path(spark, "w"), scratch_path(spark, "w")
    warc.write_pages(pages, raw, "2024-01-01T00:00:00Z")
    back = sorted(((r.page_id, r.url, r.payload) for r in warc.read(spark, raw).collect()), key=repr)
    assert back == sorted(((p, u, h or "") for p, u, h in rows), key=repr)
    warc.deduplicate(spark, raw, new, "2024-01-02T00:00:00Z", broadcast_rows=broadcast_rows)
    got = warc.read(spark, new).collect()
    assert sorted((r.page_id for r in got if r.record_type == "revisit"), key=repr) == [2, 2, 7, None]
    originals = {r.record_id: r for r in got if r.record_type == "response"}
    for r in got:
        full = r if r.record_type == "response" else originals[r.refers_to_id]
        assert full.payload_digest == r.payload_digest == hashlib.sha256(full.payload.encode()).hexdigest()
        assert r.record_type == "response" or (r.payload == "" and r.refers_to == full.page_id)


def test_warc_empty(spark):
    raw, new = scratch_path(spark, "w"), scratch_path(spark, "w")
    warc.write_pages(spark.createDataFrame([], "page_id long, url string, html string"), raw, "d")
    warc.deduplicate(spark, raw, new, "d")
    assert warc.read(spark, new).count() == 0


# 3: byte-level BPE


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_BPE, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_library(small, odd_docs, no_docs, tiktoken_encoding):
    for docs in (small, odd_docs, no_docs):
        texts = Counter((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
        both = bpe.round_trip(docs, BYTE_BPE, public_tokenizers.PATTERN).collect()
        assert Counter((r.doc_id, bytes(r.decoded).decode()) for r in both) == texts
        assert Counter((r.doc_id, tuple(r.ids)) for r in both) == Counter({(d, tuple(tiktoken_encoding.encode_ordinary(t))): n for (d, t), n in texts.items()})


def test_bpe_encode_then_decode(odd_docs):
    ids = bpe.encode(odd_docs, BYTE_BPE, public_tokenizers.PATTERN)
    back = bpe.decode(ids, BYTE_BPE, public_tokenizers.PATTERN)
    assert Counter((r.doc_id, bytes(r.decoded).decode()) for r in back.collect()) == Counter((r.doc_id, r.text or "") for r in odd_docs.collect())


def test_bpe_random_strings(tiktoken_encoding):
    rng, own = random.Random(1), bpe.codec(BYTE_BPE, public_tokenizers.PATTERN)
    for _ in range(1500):
        text = "".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(97, 105), 10, 32, rng.randrange(0x1F300, 0x1F700)])) for _ in range(rng.randint(1, 40)))
        assert own.encode(text) == tiktoken_encoding.encode_ordinary(text)


def test_perfect_hash():
    keys = [str(i).encode() for i in range(3000)]
    table = bpe.PerfectHash(keys, list(range(3000)))
    assert [table.get(k) for k in keys] == list(range(3000)) and table.get(b"other") == -1
    assert sorted(table.values) == list(range(3000))  # minimal: each slot holds one key


# 4: ORC


def test_orc_matches_library(spark, small, odd_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    for docs in (small, odd_docs):
        path = scratch_path(spark, "orc")
        orc_tokens.write_orc(docs, WORD_BPE, path, end=2)
        got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in orc_tokens.document_index(spark, path).collect()))
        rows = docs.select("doc_id", "text").collect()
        ids = [[*e.ids, 2] for e in tokenizer.encode_batch([r.text or "" for r in rows], add_special_tokens=False)]
        crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
        assert Counter(g[1:] for g in got) == Counter((r.doc_id, len(x), crc(x)) for r, x in zip(rows, ids, strict=True))
        order = [(g[1] is not None, g[1] or 0) for g in got]
        assert order == sorted(order)
        assert [g[0] for g in got] == [sum(g[2] for g in got[:i]) for i in range(len(got))]


def test_orc_lookup_is_pushed_down(spark, small):
    path = scratch_path(spark, "orc")
    orc_tokens.write_orc(small, WORD_BPE, path, end=2)
    found = orc_tokens.lookup(spark, path, [3, 5])
    assert sorted(r.doc_id for r in found.collect()) == [3, 5]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()


def test_orc_empty(spark, no_docs):
    path = scratch_path(spark, "orc")
    orc_tokens.write_orc(no_docs, WORD_BPE, path, end=2)
    assert orc_tokens.document_index(spark, path).count() == 0


# 5: language


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.predict(docs, langid.train(docs)).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in held)


def test_language_backoff():
    none = {5: {}, 4: {}, 2: {}, 1: {}}
    model = langid.Model(["de", "en"], {0: {"the": 0}, 3: {"sch": 0}, **none}, {0: np.array([[-9.0, -2.0]]), 3: np.array([[-2.0, -7.0]]), **{n: np.zeros((0, 2)) for n in none}})
    assert model.word("the")[1] > model.word("the")[0] and model.word("schuh")[0] > model.word("schuh")[1]
    assert list(model.word("qqq")) == [0, 0]


def slow_language(model, text):
    words = langid.words_of(text)
    if not any(c.isalpha() for w in words for c in w):
        return "und", 0.0
    total = sum(model.word(w).astype(float) for w in words)
    best = max(range(len(model.languages)), key=lambda i: (total[i], -i))
    return model.languages[best], 1 / sum(np.exp(min(x - total[best], 0)) for x in total)


def test_language_by_definition(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, sample=30)
    for own in (docs.limit(150), odd_docs):
        got = sorted(((r.doc_id or -1, r.lang_pred, round(r.score, 6)) for r in langid.predict(own, model).collect()))
        want = sorted((r.doc_id or -1, *slow_language(model, r.text)) for r in own.select("doc_id", "text").collect())
        assert [(d, p) for d, p, _ in got] == [(d, p) for d, p, _ in want]
        assert np.allclose([x for _, _, x in got], [x for _, _, x in want], atol=1e-4)


def test_a_rare_language_is_learnt_however_many_others_there_are(spark):
    rng = random.Random(2)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(5))
    rows = [(i, " ".join(word("abcdef") for _ in range(12)), "aa") for i in range(3000)] + [(5000 + i, " ".join(word("uvwxyz") for _ in range(12)), "zz") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, sample=10)
    assert model.languages == ["aa", "zz"]
    assert {r.lang_pred for r in langid.predict(docs.filter("lang = 'zz'"), model).collect()} == {"zz"}
    many = spark.createDataFrame([(i, f"word{i} x", f"l{i:03d}") for i in range(300)], "doc_id long, text string, lang string")
    assert len(langid.train(many).languages) > 200


def test_language_odd(odd_docs, no_docs):
    model = langid.train(odd_docs)
    got = langid.predict(odd_docs, model)
    assert got.count() == 12 and {r.lang_pred for r in got.filter("doc_id in (1, 2, 3)").collect()} == {"und"}
    assert {r.lang_pred for r in langid.predict(odd_docs, langid.train(no_docs)).collect()} == {"und"}


# 6: Jaccard


def test_jaccard_brute_force(spark):
    rng, texts = random.Random(5), {}
    base = [[rng.choice("abcdefghijklmnop") + rng.choice("xyz") for _ in range(rng.randint(3, 120))] for _ in range(10)]
    for d in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 9])):
            words[rng.randrange(len(words))] = rng.choice("abc")
        texts[d] = " ".join(words)
    texts |= {300: None, 301: " ", 302: "a b", 303: "A  b", 304: "a"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    blocks = {"hot": 2, "block_tokens": 300}  # clusters of several blocks
    for size, percent, more in ((4, 85, blocks), (3, 50, {})):
        got = by_id(jaccard.near_duplicates(df, size=size, numerator=percent, width=1 << 12, **more), "n_shingles", "component_id")
        assert got == jaccard.brute_force(texts, size, percent, 100)


def test_jaccard_small_table(spark, small):
    texts = by_id(small, "text")
    got = by_id(jaccard.near_duplicates(small, size=4, numerator=85), "n_shingles", "component_id")
    assert got == jaccard.brute_force(texts, 4, 85, 100)


def test_jaccard_odd(odd_docs, no_docs):
    kept = jaccard.keep_first(odd_docs, width=1 << 12)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 10]
    assert jaccard.keep_first(no_docs, width=1 << 12).count() == 0


def test_prefixes_lose_no_pair():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 50, 256).astype(np.uint32)
    counts[:20] = 5000
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 500, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.95], rng.integers(0, 500, 3).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if common and 100 * common >= 80 * (len(a) + len(b) - common):
            (p, l), (q, m) = (jaccard.ordered_prefix(x, counts, 25.0, 80, 100) for x in (a, b))
            assert len(np.intersect1d(p, q)) >= min(l, m)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901)], "a long, b long")
    got = {r["id"]: r["component"] for r in graph.components(links).collect()}
    assert set(got[i] for i in range(301)) == {0} and got[901] == 900 and len(got) == 303


def test_near_copies_of_rows_that_share_or_lack_an_id(spark):
    text = lambda k, n=40: " ".join(f"{k}{i}" for i in range(n))
    rows = [(1, text("a")), (1, text("b")), (2, text("a") + " z"), (None, text("b")), (None, text("c")), (4, ""), (4, "")]
    kept = jaccard.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted([(1, text("a")), (1, text("b")), (None, text("c")), (4, ""), (4, "")], key=repr)
    named = spark.createDataFrame([("x", text("a")), ("y", text("a"))], "doc_id string, text string")
    assert [r.doc_id for r in jaccard.keep_first(named).collect()] == ["x"]


# 7: repeated passages


@pytest.mark.parametrize(("passage", "seed"), [(12, 4), (8, 3)])
def test_passages_brute_force(spark, passage, seed):
    rng, texts = random.Random(3), {}
    shared = [" ".join(rng.choice("abcdefghij") for _ in range(rng.randint(8, 40))) for _ in range(6)]
    for d in range(100):
        parts = [f"start{d}"]
        for _ in range(rng.randint(0, 5)):
            parts.append(rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 30))))
        texts[d] = "\n".join(parts)
    texts |= {202: None, 203: ""}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {}
    for r in sparse_suffix.repeated_passages(df, passage=passage, seed_words=seed).collect():
        got[r.doc_id] = (set(), set())
        for x in r.spans:
            got[r.doc_id][x.original].update(range(x.start, x.end))
    assert got == sparse_suffix.brute_force(texts, passage)
    left = by_id(sparse_suffix.cut_repeats(df, passage=passage, seed_words=seed), "text")
    for d, t in texts.items():
        words, cut = (t or "").split(), got.get(d, (set(), set()))[0]
        assert (left.get(d) or "").split() == [w for i, w in enumerate(words) if i not in cut]


def test_exact_copies_are_cut(spark):
    text = " ".join(f"w{i}" for i in range(70))
    df = spark.createDataFrame([(5, text), (2, text), (9, "a " + text + " b"), (11, "short")], "doc_id long, text string")
    found = by_id(sparse_suffix.repeated_passages(df), "spans")
    assert found[5][0].first_id == 2 and not found[5][0].original and found[2][0].original
    assert by_id(sparse_suffix.cut_repeats(df), "text") == {2: text, 9: "a  b", 11: "short"}


def test_passages_of_texts_that_share_or_lack_an_id(spark):
    rng = random.Random(5)
    fill = lambda k: " ".join(f"{k}{rng.randrange(10**6)}" for _ in range(20))
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "pq")
    rows = [(1, f"{fill('a')} {one}"), (1, f"{fill('b')} {two}"), (2, f"{one} {fill('c')}"), (3, f"{two} {fill('d')}"), (None, f"{fill('e')} {two} {fill('f')}"), (None, "x y"), (None, "x y")]
    for kind in ("long", "string"):
        df = spark.createDataFrame([(None if d is None else (d if kind == "long" else str(d)), t) for d, t in rows], f"doc_id {kind}, text string").repartition(3)
        left = sorted(" ".join(r.text.split()) for r in sparse_suffix.cut_repeats(df).collect())
        cut = [t.replace(one, "") if d == 2 else t.replace(two, "") if d in (3, None) and two in t else t for d, t in rows]
        assert left == sorted(" ".join(t.split()) for t in cut)


def test_hot_passage_is_dealt_out(spark):
    hot = " ".join(f"h{i}" for i in range(60))
    texts = {d: f"s{d} " + (hot if d % 3 else " ".join(f"{d}x{i}" for i in range(60))) + f" e{d}" for d in range(600)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = sparse_suffix.suffixes(sparse_suffix.with_hashes(df, "doc_id", "text"), 50, 10).filter("seed is not null")
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merged, "false")  # so few rows would go to one task
    try:
        sizes = [r["n"] for r in sparse_suffix.matched_suffixes(found, 5).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set(merged, "true")
    assert len(sizes) == 4 and max(sizes) < 0.5 * sum(sizes)
    got = {r.doc_id: [(x.start, x.end, x.original) for x in r.spans] for r in sparse_suffix.repeated_passages(df).collect()}
    assert got == {d: [(1, 61, d == 1)] for d in range(600) if d % 3}


def test_passages_odd(odd_docs, no_docs):
    cut = sparse_suffix.cut_repeats(odd_docs)
    assert cut.columns == odd_docs.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    assert left[1] is None and left[2] == "" and left[3] == " \n\t " and left[5] == "end" and len(left) == 11
    assert sparse_suffix.cut_repeats(no_docs).count() == 0 and sparse_suffix.repeated_passages(no_docs).count() == 0


# 8: toxicity


@pytest.fixture(scope="module")
def toxic_model(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    return docs, labels, toxicity.train(docs, labels, sample=1000)


def test_toxicity_held_out(toxic_model):
    docs, labels, model = toxic_model
    held = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    got = toxicity.score_documents(docs.join(held.select("doc_id"), "doc_id", "left_semi"), model).join(held, "doc_id").collect()
    hit = [r for r in got if r.toxic == 1]
    assert np.mean([r.score >= 0.3 for r in hit]) > 0.8
    assert np.mean([r.score >= 0.3 for r in got if r.toxic == 0]) < 0.03


def test_toxicity_sample_size_leaves_scores(spark, toxic_model):
    docs, labels, _ = toxic_model
    held = docs.join(labels.filter("toxic = 0 and crc32(cast(doc_id as string)) % 4 = 2").select("doc_id"), "doc_id", "left_semi")
    few, all_ = (toxicity.train(docs, labels, sample=n) for n in (450, 100_000))  # classes 1 to 2, and as they are
    mean = [held.transform(toxicity.score_documents, m).agg(F.avg("score"), F.avg((F.col("score") >= 0.3).cast("int"))).first() for m in (few, all_)]
    assert abs(mean[0][0] - mean[1][0]) < 0.03 and abs(mean[0][1] - mean[1][1]) < 0.015


def test_toxic_spans(spark, toxic_model):
    docs, labels, model = toxic_model
    text = "Erha the you idiot and the on Moron of"
    row = toxicity.score_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [text[s.start : s.end] for s in row.spans] == ["idiot", "Moron"] and row.score > 0.3


def test_marginals_by_enumeration():
    rng = np.random.default_rng(2)
    emit, sizes, start, move = rng.normal(size=9), np.array([4, 0, 5, 0]), 0.3, rng.normal(size=(2, 2))
    p, pair = toxicity.forward_backward(emit, sizes, start, move)
    at, expected = 0, np.zeros((2, 2))
    for n in (4, 5):
        weight, marks, steps = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n):
            y = [code >> i & 1 for i in range(n)]
            w = np.exp(start * y[0] + sum(e * v for e, v in zip(emit[at : at + n], y, strict=True)) + sum(move[a, b] for a, b in zip(y, y[1:], strict=False)))
            weight, marks = weight + w, marks + w * np.array(y)
            for a, b in zip(y, y[1:], strict=False):
                steps[a, b] += w
        assert np.allclose(p[at : at + n], marks / weight)
        expected += steps / weight
        at += n
    assert np.allclose(pair, expected)


def test_toxicity_odd(spark, odd_docs, no_docs, toxic_model):
    _, _, model = toxic_model
    assert toxicity.score_documents(odd_docs, model).count() == 12
    kept = toxicity.remove_toxic(odd_docs, model)
    assert kept.columns == odd_docs.columns and 6 not in {r.doc_id for r in kept.collect()} and kept.count() == 10
    assert toxicity.remove_toxic(no_docs, model).count() == 0
    nothing = toxicity.train(odd_docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score_documents(odd_docs, nothing).collect()} == {0.0}


# 9: token counts


def test_counts_match_library(small, odd_docs, no_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_BPE)
    for docs in (small, odd_docs, no_docs):
        got = Counter(tuple(r)[:3] for r in token_counts.count_tokens(docs, WORD_BPE).collect())
        rows = docs.select("doc_id", "text").collect()
        expected = tokenizer.encode_batch([r.text or "" for r in rows], add_special_tokens=False)
        assert got == Counter((r.doc_id, len((r.text or "").encode()), len(e.ids)) for r, e in zip(rows, expected, strict=True))


def test_counts_random_strings():
    from tokenizers import Tokenizer

    rng, own = random.Random(1), token_counts.counter(WORD_BPE)
    letters = "abcdefgstrvlme' '1é!Σ<|>endoftx\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(2000)]
    texts += ["it's we're they've I'm you'll he'd 's ''s 'lx 're've 'rx!", "a<|endoftext|>b <|startoftext|>", "İstanbul ΣΑΣ", "x" * 500, "'!'s?'re 'sé"]
    expected = [len(e.ids) for e in Tokenizer.from_file(WORD_BPE).encode_batch(texts, add_special_tokens=False)]
    assert own.counts([t.encode() for t in texts]).tolist() == expected


def test_prefix_scan_of_state_maps():
    rng = np.random.default_rng(4)
    classes = rng.integers(0, 10, 5000).astype(np.int8)
    state, slow = token_counts.START, []
    for c in classes:
        slow.append(token_counts.EMIT[state, c])
        state = token_counts.STEP[state, c]
    for chunk in (1, 7, 256, 6000):
        assert (token_counts.emissions(classes, chunk) == np.array(slow)).all()


# 10: decontamination

ITEMS = [(None, "again and again"), (1, "the quick brown fox jumps over the lazy dog again and again"), (2, "Two words"), (3, None), (4, "..."), (5, "two WORDS!"), (11, "again and")]


def test_contamination_brute_force(spark, small, sf, odd_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    docs = spark.createDataFrame(
        [(1, "x the quick brown fox jumps over the lazy dog again y"), (2, "two, words; again-and"), (3, None), (4, ""), (5, "again and again and again")], "doc_id long, text string"
    )
    for d, b in ((docs, items), (small, spark.read.parquet(f"{sf}/benchmark.parquet")), (odd_docs, items), (no_docs, items), (docs, items.filter("false"))):
        rows = [(r["item_id"], r["text"]) for r in b.collect()]
        expected = Counter((r.doc_id, *decontaminate.brute_force(r.text, rows)) for r in d.select("doc_id", "text").collect())
        for size in (1 << 23, 3000 if d is small else 12):  # in one pass, and in several
            got = decontaminate.contamination(d, b, block_bytes=size).select("doc_id", "n_words", "n_hit", decontaminate.items_digest().alias("s"))
            assert Counter(map(tuple, got.collect())) == expected
            left = decontaminate.remove_contaminated(d, b, block_bytes=size)
            assert left.columns == d.columns
            assert Counter(r.doc_id for r in left.collect()) == Counter(k[0] for k in expected.elements() if k[2] == 0)


def test_longest_match_and_blocks(spark):
    docs = spark.createDataFrame([(1, "x the quick brown fox jumps over the lazy dog again y two words")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    for size in (1 << 23, 20):
        row = decontaminate.contamination(docs, items, block_bytes=size).first()
        assert tuple(row.matches[0]) == ("1", 1, 0, 10) and row["items"] == ["1", "2", "5"]
    assert decontaminate.stored_blocks(items, 10, block_bytes=20)[1] > 1
    kept = decontaminate.remove_contaminated(docs.withColumn("n", F.lit(1)), items)
    assert kept.count() == 0 and kept.columns == ["doc_id", "text", "n"]
