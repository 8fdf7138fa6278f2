"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Each source has a token constraint: its documents, taken at rates r in [0, 2],
must give its target of words.  Among all such rates entropy balancing takes
those closest to one copy each.  With the entropy of a rate on [0, 2] the convex
dual gives exponentially tilted odds, ``r / (2 - r) = exp(tilt * size / scale)``,
with one tilt per source.  Newton iterations on the dual are aggregates over
(source, size) classes, which a map-side combined count makes once, so a hot
source or a hot size costs no more than its distinct sizes.

Rates become whole copies: a class of n documents at rate r gives ``n * r``
copies up to rounding, and roundings are carried from class to class in order of
size, so what a source takes differs from its target by about one document.
Which documents of a class get the extra copy is decided by their id and a hash of
their other columns, so reruns agree however rows are partitioned.

Defined cases: null or blank text has size 0 and is taken zero times; a null
source is a source of its own and ranks last; rows that share an id, or have none,
are told apart by their other columns (but for maps and variants); rows that are
alike in all of them are documents of their own, and which of them is taken twice
makes no difference.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .store import WORD, column, settle, spread, whole_row

#: Rows of one (source, size) class are ranked in this many parts.
PARTS = 1024
TOLERANCE = 1e-9
ROUNDS = 60
#: Single copies moved after rounding, per source.
REPAIRS = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null; its bytes sort sources by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0):
    """Per source: key, source_size, target.

    ``sizes`` has key and source_size.  Weights go round the sources in order of
    their keys.  A target stops at ``most`` times the size of its source; what is
    cut is shared again by weight until none is above.  That is a water level:
    source i gets ``min(cap_i, level * weight_i)``, and the level is found from the
    sources in order of ``cap / weight``, in which the capped ones come first.
    What is ranked in one place here is the list of sources, a row each.
    """
    turn = F.pmod(F.row_number().over(W.orderBy(F.col("key").cast("binary"))) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    by_level = W.orderBy(F.col("cap") / F.col("weight"), F.col("key").cast("binary"))
    everyone = W.partitionBy()
    filled = (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("before", F.coalesce(F.sum("cap").over(by_level.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(by_level.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("level", (F.sum("source_size").over(everyone) * share - F.col("before")) / F.col("left"))
        .withColumn("capped", F.col("level") * F.col("weight") >= F.col("cap"))
        # past the first source below its cap the running levels only fall
        .withColumn("level", F.max(F.when(~F.col("capped"), F.col("level"))).over(everyone))
    )
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("level") * F.col("weight"))
    return filled.select("key", "source_size", target.alias("target"))


def _rate(tilt: Column, size: Column, most: float) -> Column:
    """The tilted rate; a null tilt is the limit in which every document is at the cap."""
    return F.when(tilt.isNull(), F.lit(most)).otherwise(most / (1 + (most - 1) * F.exp(-tilt * size)))


def tilts(classes: DataFrame, targets: DataFrame, most: float = 2.0) -> DataFrame:
    """Newton iterations on the dual: key, scale, tilt (null: rates at the cap).

    ``classes`` has key, size and n.  Newton steps are kept inside a bracket that
    each evaluation narrows, so the iteration converges from any start.
    """
    none = F.lit(None).cast("double")
    means = classes.groupBy("key").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    state = settle(
        targets.join(means, "key").select(
            "key", "target", "scale",
            ((F.col("scale") == 0) | (F.col("target") >= most * F.col("source_size") * (1 - 1e-12))).alias("fixed"),
            F.lit(0.0).alias("tilt"), none.alias("low"), none.alias("high"), none.alias("gap"),
        ),
        "tilts",
    )
    size = F.col("size") / F.col("scale")
    rate = _rate(F.col("tilt"), size, most)
    over = F.col("reached") - F.col("target")
    step = F.col("tilt") - over / F.col("slope")
    inside = (F.col("slope") > 0) & F.coalesce(step > F.col("l"), F.lit(True)) & F.coalesce(step < F.col("h"), F.lit(True))
    middle = (
        F.when(F.col("l").isNull(), F.col("h") - 1 - F.abs("h"))
        .when(F.col("h").isNull(), F.col("l") + 1 + F.abs("l"))
        .otherwise((F.col("l") + F.col("h")) / 2)
    )
    close = F.abs(over) <= TOLERANCE * F.col("target")
    for _ in range(ROUNDS):
        sums = (
            classes.join(state.filter("not fixed"), "key")
            .groupBy("key", "target", "scale", "tilt", "low", "high")
            .agg(
                F.sum(F.col("n") * F.col("size") * rate).alias("reached"),
                F.sum(F.col("n") * F.col("size") * size * rate * (1 - rate / most)).alias("slope"),
            )
            .withColumn("l", F.when(over < 0, F.col("tilt")).otherwise(F.col("low")))
            .withColumn("h", F.when(over >= 0, F.col("tilt")).otherwise(F.col("high")))
        )
        moved = sums.select(
            "key", "target", "scale", F.lit(False).alias("fixed"),
            F.when(close, F.col("tilt")).when(inside, step).otherwise(middle).alias("tilt"),
            F.col("l").alias("low"), F.col("h").alias("high"), (F.abs(over) / F.col("target")).alias("gap"),
        )
        state = settle(moved.unionByName(state.filter("fixed")), "tilts")
        if (state.agg(F.max("gap")).first()[0] or 0.0) <= TOLERANCE:
            break
    return state.select("key", "scale", F.when(~F.col("fixed"), F.col("tilt")).alias("tilt"))


def _repaired(rated: DataFrame) -> DataFrame:
    """Give or take one copy of the size that best closes what a source's rounding left open."""
    own = W.partitionBy("key")
    open_ = F.col("target") - F.sum(F.col("size") * (F.col("n") * F.col("whole") + F.col("extra"))).over(own)
    gain = F.abs(F.col("open")) - F.abs(F.abs(F.col("open")) - F.col("size"))
    can = F.when(F.col("open") > 0, (F.col("extra") < F.col("n")) & (F.col("whole") < 2)).otherwise(F.col("extra") > 0)
    best = F.max(F.when(can & (gain > 0.5), F.struct(gain.alias("gain"), "size"))).over(own)
    chosen = F.coalesce(best.getField("size") == F.col("size"), F.lit(False))
    return (
        rated.withColumn("open", open_)
        .withColumn("chosen", chosen)
        .withColumn("extra", F.when(F.col("chosen"), F.col("extra") + F.signum("open").cast("long")).otherwise(F.col("extra")))
        .drop("open", "chosen")
    )


def mixed(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, copies, taken and the ``row`` itself."""
    most = 2.0
    plain = [column(f.name) for f in docs.schema if not re.search("map<|variant", f.dataType.simpleString())]
    rows = docs.select(
        column(id_col).alias("doc_id"),
        source_key(column(source_col)).alias("key"),
        words(column(text_col)).alias("size"),
        F.xxhash64(*plain, F.lit(9)).alias("digest"),
        whole_row(docs).alias("row"),
    ).withColumn("part", F.pmod("digest", F.lit(PARTS)).cast("int"))
    counts = settle(rows.groupBy("key", "size", "part").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    classes = settle(counts.groupBy("key", "size").agg(F.sum("n").alias("n")), "mix-classes")
    sizes = classes.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = settle(source_targets(sizes, weights, share, most), "mix-targets")
    known = targets.join(tilts(classes, targets, most), "key")

    in_order = W.partitionBy("key").orderBy("size")
    rate = F.when(F.col("size") == 0, F.lit(0.0)).otherwise(_rate(F.col("tilt"), F.col("size") / F.col("scale"), most))
    rated = (
        classes.join(known, "key")
        .withColumn("rate", rate)
        .withColumn("whole", F.floor("rate"))
        .withColumn("due", F.round(F.sum(F.col("n") * (F.col("rate") - F.col("whole"))).over(in_order), 6))
        .withColumn("extra", F.floor(F.col("due") + 0.5))
        .withColumn("extra", F.col("extra") - F.coalesce(F.lag("extra").over(in_order), F.lit(0)))
    )
    for _ in range(REPAIRS):
        rated = _repaired(rated)
    rated = rated.select("key", "size", "source_size", "target", "whole", "extra")
    # extra copies go to the first documents of a class; a part knows how many come before it
    before = W.partitionBy("key", "size").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = settle(
        counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(rated, ["key", "size"])
        .select("key", "size", "part", "start", "source_size", "target", "whole", "extra"),
        "mix-parts",
    )
    ranked = rows.withColumn("rank", F.row_number().over(W.partitionBy("key", "size", "part").orderBy("digest", "doc_id")))
    copies = F.col("whole") + (F.col("start") + F.col("rank") <= F.col("extra")).cast("long")
    return (
        ranked.join(starts, ["key", "size", "part"])
        .withColumn("copies", copies.cast("long"))
        .select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "row")
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    taken = mixed(docs, **options).filter("copies > 0")
    return spread(taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), "row", docs.columns)
