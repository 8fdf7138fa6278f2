"""Cardiac-rate alarms over all limits and delays at once.

While the pulse rate is XX the heart-rate alarms count, else the pulse-rate alarms
do, and what follows on without a break is one alarm.  Neither limits nor delays
need an axis of their own: a pulse alarm gives the pieces of it outside XX, a heart
alarm those inside, and two pieces that touch at the edge of an XX run are one less.
Pieces and touches both last as long as their bucket (of two, the lesser) is above
the delay, so counts and seconds are sums over pieces and touches by bucket, added
up from the longest delay down.  One join pairs alarms with the XX runs they reach.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import DELAY_MAX, DELAY_STEP
from .ranges import overlap_join
from .runs import merge_intervals
from .slices import balance, following, scan, unsliced


def _any(condition: Column) -> Column:
    return F.max(condition.cast("int"))


def _both(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def cardiac_sweep(
    alarms: DataFrame, invalid: DataFrame, last: int = DELAY_MAX, step: int = DELAY_STEP, width: float | None = None, key: str = "session"
) -> DataFrame:
    """Per session, kind, limit and delay: alarms and whole seconds over threshold, where there are any.

    ``alarms`` are those of PR and HR at the same limits (param, kind, limit, start, stop,
    bucket; disjoint per param, kind and limit), ``invalid`` the XX runs of PR (start, stop).
    An alarm counts at the delays below its bucket.  ``width`` is that of the time
    buckets of the join; if not given, an hour or the usual length of an alarm or
    run, so that one is repeated for few of them.
    """
    side = [key, "kind", "limit"]
    own = [*side, "param"]
    rows = alarms.where("stop > start").where(F.col("param").isin("PR", "HR")).select(*own, "start", "stop", "bucket")
    runs = merge_intervals(invalid.where("stop > start"), [key], "start", "stop", touching=True).select(key, "start", "stop")
    span = (F.col("start"), F.col("stop"))
    if width is None:
        usual = [x.agg(F.avg(F.col("stop") - F.col("start"))).first()[0] or 0.0 for x in (rows, runs)]
        width = max(3600.0, *usual)
    pairs = overlap_join(rows, runs, [key], span, span, width).select("a.*", F.col("b.start").alias("xs"), F.col("b.stop").alias("xe"))
    s, e, xs, xe, bucket = (F.col(c) for c in ("start", "stop", "xs", "xe", "bucket"))
    pulse, heart = F.col("param") == "PR", F.col("param") == "HR"
    hit = (s < xe) & (e > xs)
    reached = pairs.groupBy(*own, "start").agg(
        F.sum(hit.cast("int")).alias("_inside"),
        F.sum(F.when(hit, F.least(e, xe) - F.greatest(s, xs)).otherwise(0.0)).alias("_shared"),
        _any(hit & (xs <= s)).alias("_at_start"),
        _any(hit & (xe >= e)).alias("_at_stop"),
        _any((xs <= e) & (e <= xe)).alias("_ends_by"),
        _any((xs < e) & (e < xe)).alias("_ends_in"),
    )
    whole = rows.join(reached, [*own, "start"], "left").fillna(0).fillna(0.0)
    whole = scan(balance(whole, own, "start"), own, ["start"], _next=following("start"), _next_bucket=following("bucket"))
    whole = unsliced(whole)
    pieces = whole.select(
        *side,
        "bucket",
        F.when(pulse, 1 + F.col("_inside") - F.col("_at_start") - F.col("_at_stop")).otherwise(F.col("_inside")).alias("n"),
        F.when(pulse, e - s - F.col("_shared")).otherwise(F.col("_shared")).alias("seconds"),
    )
    # alarms of one series that follow each other without a break
    goes_on = F.when(pulse, F.col("_ends_by") == 0).otherwise(F.col("_ends_in") == 1)
    series = whole.where((F.col("_next") == e) & goes_on).select(*side, F.least("bucket", "_next_bucket").alias("bucket"))
    # a pulse alarm up to the beginning of a run and a heart alarm from there on, and the other way round at its end
    edges = pairs.groupBy(*side, "xs", "xe").agg(
        F.max(F.when(pulse & (s < xs) & (e >= xs), bucket)).alias("_before"),
        F.max(F.when(heart & (s <= xs) & (e > xs), bucket)).alias("_head"),
        F.max(F.when(heart & (s < xe) & (e >= xe), bucket)).alias("_tail"),
        F.max(F.when(pulse & (s <= xe) & (e > xe), bucket)).alias("_after"),
    )
    both = F.array(_both(F.col("_before"), F.col("_head")), _both(F.col("_tail"), F.col("_after")))
    across = edges.select(*side, F.explode(both).alias("bucket")).where("bucket is not null")
    touches = series.unionByName(across).select(*side, "bucket", F.lit(-1).alias("n"), F.lit(0.0).alias("seconds"))

    top = F.least(F.ceil(bucket / step) - 1, F.lit(last // step)).cast("int")
    counts = (
        pieces.where("n > 0").unionByName(touches).where("bucket > 0")
        .groupBy(*side, top.alias("_top"))
        .agg(F.sum("n").alias("_n"), F.sum("seconds").alias("_time"))
    )
    down = Window.partitionBy(*side).orderBy(F.col("_top").desc())  # at most one row per delay
    upto = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counts.select(
        *side,
        "_top",
        F.coalesce(F.lead("_top").over(down), F.lit(-1)).alias("_below"),
        F.sum("_n").over(upto).alias("alarms"),
        F.sum("_time").over(upto).cast("bigint").alias("time_over_threshold"),
    ).where("alarms > 0")
    return summed.withColumn("_d", F.explode(F.sequence(F.col("_below") + 1, F.col("_top")))).select(
        *side, (F.col("_d") * step).cast("bigint").alias("delay"), "alarms", "time_over_threshold"
    )
