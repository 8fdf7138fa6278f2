"""Inverted index of word pieces over message templates.

A search term is tried on a template by regular expressions (see
:func:`bedside.plans.log_search.matching_templates`).  With a large dictionary most of
those tries fail, and why can be told without them: a template can only match a term
that holds all its fixed text, and a plain term is only found in a template that holds
it.  The index has the pieces (three characters each) of that text, so a term meets
the templates that share its pieces.  Templates and terms about which pieces say
nothing (too short, or with operators of regular expressions) meet all others, so the
result is the same as without the index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import PLACEHOLDER
from ..session import literal_table

PIECE = 3
# Signs that stand for no character of their own, and signs after which text may be optional.
LOOSE = r"[.$^]"
OPERATOR = r"[\\\[\]{}()|?*+]"


def _pieces(runs: Column) -> Column:
    """Distinct pieces of all runs of text."""
    cut = F.transform(
        F.filter(runs, lambda run: F.length(run) >= PIECE),
        lambda run: F.transform(
            F.sequence(F.lit(1), F.length(run) - (PIECE - 1)), lambda at: F.substring(run, at, F.lit(PIECE))
        ),
    )
    return F.array_distinct(F.flatten(cut))


def _fixed(text: Column, between: str) -> Column:
    """The pieces that whatever ``text`` matches must hold; none where an operator makes that uncertain."""
    operators = F.rlike(F.regexp_replace(text, between, ""), F.lit(OPERATOR))
    return F.when(operators, F.array().cast("array<string>")).otherwise(_pieces(F.split(text, between)))


def template_index(templates: DataFrame) -> DataFrame:
    """Postings (piece, id, needed, held) of templates (id, cipher) with unique ids.

    ``needed``: how many pieces of its fixed text the template has, where this piece is
    one of them; null for a piece that is just in its text.  ``held``: the piece is in its
    text.  A template with nothing to go by has one row with the piece null, which meets
    every term.  Templates without text have no rows: they match nothing.
    """
    between = f"{PLACEHOLDER}|{LOOSE}"
    # a dictionary is a small file, cutting its texts is not: deal it to all cores
    tasks = 3 * templates.sparkSession.sparkContext.defaultParallelism
    df = templates.where(F.col("cipher").isNotNull()).repartition(tasks, "id").select(
        "id",
        _fixed(F.col("cipher"), between).alias("_fixed"),
        _pieces(F.array("cipher")).alias("_held"),
    )
    df = df.withColumn("_n", F.size("_fixed"))
    own = F.transform(
        F.array_union("_held", "_fixed"),
        lambda p: F.struct(
            p.alias("piece"),
            F.when(F.array_contains("_fixed", p), F.col("_n")).alias("needed"),
            F.array_contains("_held", p).alias("held"),
        ),
    )
    open_row = F.struct(
        F.lit(None).cast("string").alias("piece"), F.lit(None).cast("int").alias("needed"), F.lit(False).alias("held")
    )
    rows = F.when(F.col("_n") == 0, F.concat(own, F.array(open_row))).otherwise(own)
    return df.select(F.explode(rows).alias("p"), "id").select("p.piece", "id", "p.needed", "p.held")


def save_index(index: DataFrame, path: str) -> None:
    """Write postings in order of their pieces, so that a search reads the row groups of its own pieces."""
    index.repartitionByRange("piece").sortWithinPartitions("piece", "id").write.mode("overwrite").parquet(path)


def candidates(index: DataFrame, templates: DataFrame, terms: Sequence[str]) -> DataFrame:
    """(id, term) pairs worth trying, each once.

    The terms' pieces are a table of literals; postings are filtered by them in the scan.
    Posting lists are met piece by piece and counted per pair, so a frequent piece is
    no group of its own.
    """
    spark = index.sparkSession
    terms = list(dict.fromkeys(t for t in terms if t))
    if not terms:
        return index.select("id", F.lit("").alias("term")).where(F.lit(False))
    given = literal_table(spark, [(t,) for t in terms], "term string").select(
        "term",
        # a template that matches the term, or the term and a blank
        _pieces(F.array(F.concat("term", F.lit(" ")))).alias("around"),
        # a template in which the term is found
        _fixed(F.col("term"), LOOSE).alias("inside"),
    )
    # rows without a piece meet every term, in the same pass over the postings
    open_row = F.array(F.lit(None).cast("string"))
    pieces = given.select(
        "term",
        F.size("inside").alias("wanted"),
        F.explode(F.concat(F.array_union("around", "inside"), open_row)).alias("piece"),
        "around",
        "inside",
    ).select(
        "term", "wanted", "piece",
        F.coalesce(F.array_contains("around", F.col("piece")), F.lit(False)).alias("around"),
        F.coalesce(F.array_contains("inside", F.col("piece")), F.lit(False)).alias("inside"),
    ).withColumnRenamed("piece", "_piece")
    met = (
        index.join(pieces, F.col("piece").eqNullSafe(F.col("_piece")))
        .groupBy("id", "term")
        .agg(
            F.count_if(F.col("around") & F.col("needed").isNotNull()).alias("_fits"),
            F.max("needed").alias("_needed"),
            F.count_if(F.col("inside") & F.col("held")).alias("_holds"),
            F.max("wanted").alias("_wanted"),
            F.max(F.col("piece").isNull()).alias("_open"),
        )
        .where(F.col("_open") | (F.col("_fits") == F.col("_needed")) | (F.col("_wanted") > 0) & (F.col("_holds") == F.col("_wanted")))
        .select("id", "term")
    )
    # the terms are few and given: which of them have nothing to go by is not asked per template
    loose = [r.term for r in given.where(F.size("inside") == 0).select("term").collect()]
    if not loose:
        return met
    open_terms = F.array(*[F.lit(t) for t in loose])
    anywhere = templates.where(F.col("cipher").isNotNull()).select("id", F.explode(open_terms).alias("term"))
    return met.unionByName(anywhere).distinct()
