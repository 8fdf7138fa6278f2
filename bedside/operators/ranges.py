"""Interval joins on a bucketed equi key, and what is built on them.

An interval is repeated for every bucket of the axis it touches, so the join
is an equi join on (keys, bucket): a hot key is spread over its buckets and
what is left of skew is split by adaptive execution.  A pair is emitted only in
the first bucket both sides share, so no distinct is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _buckets(lo: Column, hi: Column, width: float) -> Column:
    first = F.floor(lo / F.lit(width)).cast("bigint")
    last = F.floor(hi / F.lit(width)).cast("bigint")
    return F.sequence(first, F.greatest(first, last))


def overlap_join(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    a_span: tuple[Column, Column],
    b_span: tuple[Column, Column],
    width: float,
    how: str = "inner",
) -> DataFrame:
    """Pairs of rows whose closed spans overlap; columns ``a`` and ``b`` (structs).

    Strict or half-open rules are a filter on the result.  ``how="left"`` keeps
    rows of ``a`` without a partner in their first bucket.
    """
    left = a.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.struct(*a.columns).alias("a"),
        a_span[0].cast("double").alias("_a0"),
        a_span[1].cast("double").alias("_a1"),
        F.explode(_buckets(a_span[0], a_span[1], width)).alias("_bucket"),
    )
    right = b.select(
        *[F.col(k).alias(f"_j{i}") for i, k in enumerate(keys)],
        F.struct(*b.columns).alias("b"),
        b_span[0].cast("double").alias("_b0"),
        b_span[1].cast("double").alias("_b1"),
        F.explode(_buckets(b_span[0], b_span[1], width)).alias("_bucket_b"),
    )
    on = (F.col("_bucket") == F.col("_bucket_b")) & (F.col("_a0") <= F.col("_b1")) & (
        F.col("_b0") <= F.col("_a1")
    )
    on = on & (
        F.col("_bucket")
        == F.floor(F.greatest(F.col("_a0"), F.col("_b0")) / F.lit(width)).cast("bigint")
    )
    for i in range(len(keys)):
        on = on & (F.col(f"_k{i}") == F.col(f"_j{i}"))
    # both sides are larger than their plan says (rows per bucket): never build one on the driver
    pairs = left.join(right.hint("merge"), on, "inner").select("a", "b")
    if how == "inner":
        return pairs
    raise ValueError("only inner pairs; aggregate and join back for outer forms")


def point_join(
    points: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    at: Column,
    span: tuple[Column, Column],
    width: float,
) -> DataFrame:
    """Pairs (point ``a``, span ``b``) with the point inside the closed span."""
    return overlap_join(points, spans, keys, (at, at), span, width)


def modules_at(
    logs: DataFrame, modules: DataFrame, width: float = 86400.0, ident: Sequence[str] = ("log_id",)
) -> DataFrame:
    """Modules active on the device at each log time (ends included), sorted.

    ``logs`` has device_id, t and the ``ident`` columns; ``modules`` device_id,
    module, start, stop.  Only logs with a module appear.
    """
    pairs = point_join(
        logs, modules, ["device_id"], F.col("t"), (F.col("start"), F.col("stop")), width
    )
    return pairs.groupBy(*[F.col(f"a.{c}").alias(c) for c in ident]).agg(
        F.sort_array(F.collect_set("b.module")).alias("modules")
    )


def chunks_of_blocks(chunks: DataFrame, blocks: DataFrame, width: float = 3_600_000.0) -> DataFrame:
    """Chunks whose sequence range overlaps a block's (closed ends, same segment)."""
    pairs = overlap_join(
        blocks,
        chunks,
        ["session", "segment"],
        (F.col("min_sn"), F.col("max_sn")),
        (F.col("sn0"), F.col("sn1")),
        width,
    )
    return pairs.select(
        "a.session", "a.segment", F.col("a.num").alias("block"), F.col("b.num").alias("chunk"),
        "a.min_sn", "a.max_sn",
    )


def label_windows(
    windows: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str] = ("session",),
    width: float = 4096.0 * 16,
    form: str = "overlap",
) -> DataFrame:
    """Share of each window inside a tagged interval and the label share >= 0.5.

    The largest share of any interval counts.  ``form`` keeps only the
    intervals that start inside the window ("starts"), end inside it ("ends")
    or cover it ("covers").
    """
    pairs = overlap_join(
        windows, intervals, keys, (F.col("start"), F.col("stop")), (F.col("begin"), F.col("end")), width
    )
    w0, w1, b, e = F.col("a.start"), F.col("a.stop"), F.col("b.begin"), F.col("b.end")
    keep = {
        "overlap": F.lit(True),
        "starts": (b > w0) & (b < w1),
        "ends": (e > w0) & (e < w1) & (b <= w0),
        "covers": (b <= w0) & (e >= w1),
    }[form]
    share = F.greatest(F.lit(0), F.least(w1, e) - F.greatest(w0, b)) / (w1 - w0)
    best = (
        pairs.where(keep)
        .groupBy(*[F.col(f"a.{c}").alias(c) for c in (*keys, "start", "stop")])
        .agg(F.max(share).alias("_share"))
    )
    out = windows.join(best, [*keys, "start", "stop"], "left")
    return (
        out.withColumn("share", F.coalesce("_share", F.lit(0.0)))
        .drop("_share")
        .withColumn("label", (F.col("share") >= 0.5).cast("int"))
    )


def overlap_counts(a: DataFrame, b: DataFrame, keys, width: float) -> DataFrame:
    """Each row of ``a`` (start, stop) with its number of overlapping ``b`` rows and seconds."""
    pairs = overlap_join(
        a, b, keys, (F.col("start"), F.col("stop")), (F.col("start"), F.col("stop")), width
    )
    lo = F.greatest(F.col("a.start"), F.col("b.start"))
    hi = F.least(F.col("a.stop"), F.col("b.stop"))
    hit = pairs.where(hi > lo).groupBy(
        *[F.col(f"a.{c}").alias(c) for c in (*keys, "start", "stop")]
    ).agg(F.count(F.lit(1)).alias("_n"), F.sum(hi - lo).alias("_s"))
    return (
        a.join(hit, [*keys, "start", "stop"], "left")
        .withColumn("overlaps", F.coalesce("_n", F.lit(0)))
        .withColumn("shared", F.coalesce("_s", F.lit(0).cast(a.schema["start"].dataType)))
        .drop("_n", "_s")
    )


def compare_episodes(
    reference: DataFrame, detected: DataFrame, keys=("session",), width: float = 3600.0
) -> DataFrame:
    """Episode and duration sensitivity / positive predictivity per key.

    Both sides (start, stop) must be disjoint, as interval merging leaves
    them.  An episode counts when it overlaps any of the other side.
    """
    r = overlap_counts(reference, detected, keys, width).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("reference_episodes"),
        F.sum((F.col("overlaps") > 0).cast("bigint")).alias("reference_hit"),
        F.sum(F.col("stop") - F.col("start")).alias("reference_time"),
        F.sum("shared").alias("shared_time"),
    )
    d = overlap_counts(detected, reference, keys, width).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("detected_episodes"),
        F.sum((F.col("overlaps") > 0).cast("bigint")).alias("detected_hit"),
        F.sum(F.col("stop") - F.col("start")).alias("detected_time"),
    )
    ratio = lambda x, y: F.try_divide(F.col(x).cast("double"), F.col(y).cast("double"))
    zero = ["reference_episodes", "reference_hit", "detected_episodes", "detected_hit"]
    out = r.join(d, list(keys), "full").fillna(
        0, [*zero, "reference_time", "shared_time", "detected_time"]
    )
    return (
        out.withColumn("episode_sensitivity", ratio("reference_hit", "reference_episodes"))
        .withColumn("episode_predictivity", ratio("detected_hit", "detected_episodes"))
        .withColumn("duration_sensitivity", ratio("shared_time", "reference_time"))
        .withColumn("duration_predictivity", ratio("shared_time", "detected_time"))
    )


def hourly_census(
    sessions: DataFrame, units: DataFrame, first_day: str, last_day: str, min_minutes: float = 30.0
) -> DataFrame:
    """Devices connected in each hour per care unit; the last day is excluded.

    ``sessions`` has site_id, device_id, care_unit, start, stop (timestamps)
    and takes part when it lies in the day range and lasts longer than
    ``min_minutes``; identical intervals count once.  ``units`` (site_id,
    care_unit, may hold null) spans the grid, so empty hours stay as zero.
    """
    kept = (
        sessions.where(F.to_date("start") >= F.lit(first_day).cast("date"))
        .where(F.to_date("stop") <= F.lit(last_day).cast("date"))
        .where(F.unix_micros("stop") - F.unix_micros("start") > int(min_minutes * 60_000_000))
        .select("site_id", "care_unit", "device_id", "start", "stop")
        .distinct()
    )
    hour = F.expr("interval 1 hour")
    # a session ending exactly on the hour does not reach into the next one
    last = F.date_trunc("hour", F.col("stop") - F.expr("interval 1 microsecond"))
    counts = (
        kept.select(
            "site_id", "care_unit", F.explode(F.sequence(F.date_trunc("hour", "start"), last, hour)).alias("at")
        )
        .groupBy("site_id", "care_unit", "at")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    days = F.sequence(
        F.lit(first_day).cast("date"), F.date_sub(F.lit(last_day).cast("date"), 1)
    )
    grid = units.select(
        "site_id", F.col("care_unit"), F.explode(days).alias("date")
    ).select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    c = counts.select(
        F.col("site_id").alias("_s"),
        F.col("care_unit").alias("_c"),
        F.to_date("at").alias("_d"),
        F.hour("at").alias("_h"),
        "_n",
    )
    same = (
        (F.col("site_id") == F.col("_s"))
        & F.col("care_unit").eqNullSafe(F.col("_c"))
        & (F.col("date") == F.col("_d"))
        & (F.col("hour") == F.col("_h"))
    )
    return grid.join(c, same, "left").select(
        "site_id",
        "care_unit",
        "date",
        F.col("hour").cast("bigint").alias("hour"),
        F.coalesce("_n", F.lit(0)).alias("devices"),
    )


LOOKBACK = 900.0
# Smallest position change that counts (degrees; centimetres).
POSTURE_CHANGE = (12.0, 25.0)
ARM_CHANGE = (8.0, 8.0)


def _before_start(
    cal: DataFrame, events: DataFrame, lookback: float, *, open_start: bool = False
) -> DataFrame:
    """Pairs of a calibration and the events in the look-back before it starts."""
    pairs = point_join(
        events, cal, ["session"], F.col("t"), (F.col("start") - lookback, F.col("start")), lookback
    )
    start = F.col("b.start")
    pairs = pairs.where(F.col("a.t") < start)
    return pairs.where(F.col("a.t") > start - lookback) if open_start else pairs


def _position_change(cal: DataFrame, positions: DataFrame, limits, lookback: float) -> DataFrame:
    """Last time a position differed from its final value by the limit or more."""
    pairs = _before_start(cal, positions.where("pos1 < 16000"), lookback).select(
        F.col("b.cal_id").alias("cal_id"),
        F.col("a.t").alias("t"),
        F.col("a.seq").alias("seq"),
        F.col("a.pos1").alias("pos1"),
        F.col("a.pos2").alias("pos2"),
    )
    final = pairs.groupBy("cal_id").agg(
        F.max_by("pos1", F.struct("t", "seq")).alias("_f1"),
        F.max_by("pos2", F.struct("t", "seq")).alias("_f2"),
    )
    moved = lambda p, f, lim: F.max(F.when(F.abs(F.col(p) - F.col(f)) >= lim, F.col("t")))
    return (
        pairs.join(final, "cal_id")
        .groupBy("cal_id")
        .agg(moved("pos1", "_f1", limits[0]).alias("_m1"), moved("pos2", "_f2", limits[1]).alias("_m2"))
        .select("cal_id", F.greatest("_m1", "_m2").alias("at"))
    )


def calibration_times(
    calibrations: DataFrame,
    cuff: DataFrame,
    connections: DataFrame,
    swaps: DataFrame,
    posture: DataFrame,
    arm: DataFrame,
    lookback: float = LOOKBACK,
) -> DataFrame:
    """Start of each cuff calibration, time since it became possible, inflation time.

    Looks back 15 minutes from the calibration start for the last cuff
    reading, the first cuff connection (bit 2), the first device swap and the
    last posture or arm-height change; the latest of them starts the wait.
    ``calibrations`` has session, cal_id, t_stop, stop_sn, start_sn.
    """
    cal = calibrations.select(
        "session",
        "cal_id",
        "t_stop",
        (F.col("t_stop") - (F.col("stop_sn") - F.col("start_sn")) / 500.0).alias("start"),
    )

    def edge(events, agg, **kw):
        return (
            _before_start(cal, events, lookback, **kw)
            .groupBy(F.col("b.cal_id").alias("cal_id"))
            .agg(agg(F.col("a.t")).alias("at"))
        )

    parts = {
        "_bp": edge(cuff, F.max),
        "_conn": edge(connections.where(F.col("bits").bitwiseAND(2) == 2), F.min),
        "_swap": edge(swaps, F.min, open_start=True),
        "_post": _position_change(cal, posture, POSTURE_CHANGE, lookback),
        "_arm": _position_change(cal, arm, ARM_CHANGE, lookback),
    }
    out = cal
    for name, part in parts.items():
        out = out.join(part.withColumnRenamed("at", name), "cal_id", "left")
    since = F.greatest(*[F.coalesce(n, F.lit(0.0)) for n in parts])
    return out.select(
        "session",
        "cal_id",
        "start",
        F.when(since > 0, F.col("start") - since).otherwise(F.lit(-1.0)).alias("fill_time"),
        (F.col("t_stop") - F.col("start")).alias("inflation_time"),
    )
