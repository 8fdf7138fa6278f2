"""The corpus operators over the driver tables, with production parameters.

``QUERIES`` maps a name to a function of (spark, sf_dir); ``ORACLES`` has DuckDB
SQL for the same rows where SQL can express them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, quality
from .exact_dedup import exact_duplicates
from .fill_middle import fill_in_middle, restored
from .html_text import extracted
from .mixing import mixed
from .near_dedup import near_duplicates
from .packing import packed, token_pieces
from .pii import surrogates
from .pivot_search import top_k
from .sharding import sharded
from .store import LOWER, UPPER, table
from .token_counts import token_counts
from .whitening import whitened


def fold(parts: int) -> Column:
    """The part of a document: CRC-32 of its id as text, modulo ``parts``; null for a row without id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return packed(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(fold(4) != 2)
    model = quality.fit(docs, labels, "quality")
    held_out = F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out")
    scored = docs.select("doc_id", held_out, quality.scored(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op6_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256.0)


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates(table(spark, sf_dir, "documents"), key="corpus release 1")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(fold(3) != 1), public_tokenizers.path("piece_bpe_32k.model"))
    held_out = F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out")
    return docs.select("doc_id", held_out, language.identified(model, F.col("text")).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score"
    )


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitened(table(spark, sf_dir, "embeddings"), components=8, weights="counts", scale=1024.0, shift=100_000)
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"), shards=24)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(table(spark, sf_dir, "documents"), units="lines", seed=7, rate=100, spm=50)
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_best_fit_packing, op3_quality_classifier, op4_token_counts, op5_minhash_near_dedup, op6_pivot_top_k,
        op7_pii_surrogates, op8_language_id, op9_source_mixing, op10_html_extraction, op11_embedding_whitening,
        op12_minimax_sharding, op13_fill_in_middle,
    )
}

ORACLES = {
    "op6_pivot_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
 r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op1_exact_dedup": f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS normal FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(normal) AS text_sha256
FROM d WINDOW w AS (PARTITION BY normal)""",
    "op13_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l FROM documents),
 c AS (SELECT *, len(l) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(l) + 1) AS h1, ('0x' || substr(h, 9, 8))::BIGINT % (len(l) + 1) AS h2,
    ('0x' || substr(h, 25, 8))::BIGINT % 100 < 50 AS s,
    t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain FROM d),
 p AS (SELECT *, array_to_string(l[1:least(h1, h2)], '') AS a, array_to_string(l[least(h1, h2) + 1:greatest(h1, h2)], '') AS m,
    array_to_string(l[greatest(h1, h2) + 1:n], '') AS z FROM c)
SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN s THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN length(a)::BIGINT END AS prefix_chars, CASE WHEN NOT plain THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE WHEN plain THEN t WHEN s THEN '<S>' || z || '<P>' || a || '<M>' || m
    ELSE '<P>' || a || '<S>' || z || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM p""",
}
