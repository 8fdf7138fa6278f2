"""A corpus from raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
that the stage before it kept.  All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside.llm import exact_dedup, language, mixing, near_dedup, packing
from bedside.llm.store import column, settle, spread, table, whole_row


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null text or no letter) go, also where no row is labelled and nothing can be learned."""
    model = language.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    if not model.languages:
        return docs.filter(language.lettered(column("text").cast("string")))
    rows = docs.select(whole_row(docs).alias("row"), language.identified(model, column("text").cast("string")).alias("found"))
    return spread(rows.filter(F.col("found.lang_pred") != language.UND), "row", docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case) the document with the smallest id stays."""
    return exact_dedup.without_copies(docs, keep="smallest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 or more over five-word shingles the smallest id stays."""
    return near_dedup.without_near_copies(docs, shingle=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to target weights; a document comes out as often as the mix takes it."""
    return mixing.mixture(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of at most 4096 ids with their sequence and place in it."""
    return packing.packed(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1))


STAGES = [
    ("language id", identify),
    ("exact dedup", exact),
    ("minhash near-dedup", near),
    ("source mixing", mix),
    ("best-fit packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's rows written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
