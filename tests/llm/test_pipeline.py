"""Registered queries on the smallest tables, and the pipeline's stages on odd input."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from venturelens.llm.queries import LLM_REGISTRY

COLUMNS = {
    "op1_host_quality": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op2_warc_revisits": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op3_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op4_orc_tokens": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op5_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op6_ngram_jaccard": ["doc_id", "n_shingles", "component_id"],
    "op7_sparse_suffix": ["doc_id", "spans"],
    "op8_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op9_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op10_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op11_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12_imatch": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op13_importance_resampling": ["doc_id", "n_features", "weight", "score", "rank"],
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query(spark, sf, name):
    df = entry.queries()[name](spark, sf)
    assert set(COLUMNS[name]) <= set(df.columns)
    rows = df.collect()
    if name != "op7_sparse_suffix":
        assert len(rows) == spark.read.parquet(f"{sf}/{'pages' if name.startswith('op2') else 'documents'}.parquet").count()
    sql = entry.oracle_sql().get(name)
    if sql:
        con = duckdb.connect()
        for f in glob.glob(f"{sf}/*.parquet"):
            con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        assert sorted(cur.fetchall(), key=repr) == sorted((tuple(r[c] for c in names) for r in rows), key=repr)


def test_names_and_registration():
    assert len(LLM_REGISTRY) == 13 and "pipeline" in entry.queries()


def test_pipeline(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.run(spark, sf)
    rows = {r.doc_id: r for r in out.collect()}
    assert 0 < len(rows) < documents.count() and len(rows) == out.count()
    # Whole texts come back from the ids, but for the passages that were cut.
    texts = {r.doc_id: r.text for r in documents.collect()}
    for d, r in rows.items():
        assert r.n_tokens == len(r.ids) and len(r.text) <= len(texts[d])
    assert sum(r.text == texts[d] for d, r in rows.items()) > 0.8 * len(rows)


@pytest.mark.parametrize("k", range(5))
def test_stage_on_odd_input(spark, sf, odd_docs, no_docs, k):
    _, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, odd_docs, sf)
    if k < 4:
        assert out.columns == odd_docs.columns
    assert {1, 2, 3} <= {r.doc_id for r in out.collect()}  # texts without words stay
    assert stage(spark, no_docs, sf).count() == 0
