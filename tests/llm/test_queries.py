"""The registered corpus queries on the smallest tables, and the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter

import pytest
from compare import compare, duck

import corpus_pipeline
from bedside.llm import queries

from .fixtures import SCHEMA, documents, texts

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_exact_dedup": {"doc_id", "keep_id", "group_size", "kept", "text_sha256"},
    "op2_best_fit_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op3_quality_classifier": {"doc_id", "held_out", "score", "predicted"},
    "op4_token_counts": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op5_minhash_near_dedup": {"doc_id", "n_shingles", "component_id", "kept"},
    "op6_pivot_top_k": {"query_id", "rank", "vec_id", "score"},
    "op7_pii_surrogates": {"doc_id", "text", "n_entities", "entities"},
    "op8_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op9_source_mixing": {"doc_id", "size", "source_size", "target", "taken"},
    "op10_html_extraction": {"page_id", "url", "text", "n_chars"},
    "op11_embedding_whitening": {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"},
    "op12_minimax_sharding": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op13_fill_in_middle": {"doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"},
}


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_matches_twin(spark, name):
    ok, _, note = compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert ok, note


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_columns_and_rows(spark, name):
    found = queries.QUERIES[name](spark, SF)
    assert COLUMNS[name] <= set(found.columns)
    table = {"op10_html_extraction": "pages", "op11_embedding_whitening": "embeddings"}.get(name, "documents")
    first = {"op2_best_fit_packing": "piece = 0", "op11_embedding_whitening": "component = 1"}.get(name)
    rows = found.filter(first) if first else found
    assert rows.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_held_out_quality_and_language(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = queries.op3_quality_classifier(spark, sf).filter("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in scored) >= 0.95 * len(scored) > 50
    langs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    found = queries.op8_language_id(spark, sf).filter("held_out").join(langs, "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in found) >= 0.98 * len(found) > 200


def test_stages(spark):
    """Each stage on awkward rows: columns stay, decisions take effect, nothing else goes."""
    docs = documents(spark).cache()
    stages = dict(corpus_pipeline.STAGES)
    rows = Counter((r[0], r[1]) for r in texts())
    with_letters = {k: n for k, n in rows.items() if k[1] and any(c.isalpha() for c in k[1])}
    out = stages["language id"](spark, docs, SF)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(with_letters)
    out = stages["exact dedup"](spark, docs, SF)
    kept = {r["doc_id"] for r in out.collect()}
    assert out.columns == docs.columns and {1, 3, 4, 5, 8, 11} <= kept and not {2, 9} & kept
    out = stages["minhash near-dedup"](spark, docs, SF)
    kept = {r["doc_id"] for r in out.collect()}
    assert out.columns == docs.columns and {1, 4, 5, 6, 7} <= kept and not {2, 3, 9} & kept
    out = stages["source mixing"](spark, docs, SF)
    assert out.columns == docs.columns and max(Counter(r["doc_id"] for r in out.collect() if r["doc_id"] not in (None, 11)).values()) <= 2
    out = stages["best-fit packing"](spark, docs, SF)
    assert out.filter("piece = 0").count() == len(texts())
    none = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_language_stage_without_any_label(spark):
    """Where no row has a language, nothing can be learned, but texts with a letter stay."""
    rows = [(r[0], r[1], None, r[3]) for r in texts()]
    out = dict(corpus_pipeline.STAGES)["language id"](spark, documents(spark, rows), SF)
    want = Counter((r[0], r[1]) for r in rows if r[1] and any(c.isalpha() for c in r[1]))
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == want and want


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows
    filled: dict = {}
    for r in rows:
        filled[r["sequence_id"]] = filled.get(r["sequence_id"], 0) + r["length"]
    assert max(filled.values()) <= 4096
