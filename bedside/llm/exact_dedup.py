"""Exact duplicates: 128-bit content hash, byte comparison inside each group.

A text's group is the first 128 bits of the SHA-256 of its normalised form.
Rows are aggregated by that hash *and* the normalised text, so Spark compares
the bytes inside a group and two texts that share a hash stay apart.  Copies
meet in the map-side part of that aggregation: a group that holds a third of
all rows leaves one row per map task, and no group is ever gathered.

Defined cases: null text is the empty text (all empty texts are copies of each
other); a row without id never wins over one with an id, and a group without
any id keeps all its rows, since they cannot be told apart; a repeated row (same
id and text) is one document given twice and both rows come out alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import ascii_lower, column, spread, whole_row


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    normal = ascii_lower(column(text_col))
    return docs.select(
        column(id_col).alias("doc_id"),
        normal.alias("normal"),
        F.sha2(normal, 256).alias("sha"),
        whole_row(docs).alias("row"),
    ).withColumn("hash", F.unhex(F.substring("sha", 1, 32)))


def classes(docs: DataFrame, keep: str = "largest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct normalised text: hash, sha, keep_id, group_size."""
    stays = {"largest": F.max, "smallest": F.min}[keep]
    return (
        _hashed(docs, id_col, text_col)
        .groupBy("hash", "normal")
        .agg(stays("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", F.sha2("normal", 256).alias("sha"), "keep_id", "group_size")
    )


def exact_duplicates(
    docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = _hashed(docs, id_col, text_col).select("doc_id", "hash", "sha")
    groups = classes(docs, keep, id_col, text_col)
    return rows.join(groups, ["hash", "sha"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def without_copies(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = _hashed(docs, id_col, text_col).select("doc_id", "hash", "sha", "row").alias("r")
    groups = classes(docs, keep, id_col, text_col).alias("g")
    met = rows.join(
        groups,
        (F.col("r.hash") == F.col("g.hash"))
        & (F.col("r.sha") == F.col("g.sha"))
        & F.col("r.doc_id").eqNullSafe(F.col("g.keep_id")),
        "left_semi",
    )
    return spread(met, "row", docs.columns)
