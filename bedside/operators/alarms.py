"""Threshold alarms: leaky bucket, delay sweep, cardiac overlay, drift alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..model import DELAY_MAX, DELAY_STEP, LEAK_PER_SECOND, LIMIT_RANGES
from ..session import literal_table
from . import slices
from .runs import ORDER, SERIES
from .slices import (
    balance,
    filled_before,
    following,
    overall_max,
    previous,
    running_min,
    running_sum,
    scan,
    unsliced,
)

ALARM, NORM, XX = 1, 0, -1


def limit_table(spark: SparkSession, ranges=None) -> DataFrame:
    """The swept limits: one row (param, kind, first, last, step) per side."""
    ranges = LIMIT_RANGES if ranges is None else ranges
    rows = [(param, kind, *span, 1)[:5] for (param, kind), span in ranges.items()]
    return literal_table(spark, rows, "param string, kind string, first int, last int, step int")


def classify(kind: str, value: Column, limit: Column) -> Column:
    """ALARM, NORM or XX of a reading against a limit (null: in no class)."""
    invalid = value.isin(-1.0, -2.0, -3.0)
    if kind == "HIGH":
        return (
            F.when((value >= limit) | (value == -4), ALARM)
            .when((value >= 0) | (value == -5), NORM)
            .when(invalid, XX)
        )
    return (
        F.when(((value <= limit) & (value >= 0)) | (value == -5), ALARM)
        .when(value > limit, NORM)
        .when(invalid, XX)
    )


def _classified(kind: str, value: Column) -> Column:
    codes = (-1.0, -2.0, -3.0, -4.0, -5.0) if kind == "HIGH" else (-1.0, -2.0, -3.0, -5.0)
    return F.when((value >= 0) | value.isin(*codes), value)


def _reached(kind: Column, level: Column, count: Column) -> Column:
    """How many limits of a range lie at or below (LOW: below) a reading.

    ++ is above every limit and -- below; a series starts as NORM.
    """
    at = (level - F.col("first")) / F.col("step")
    n = F.when(kind == "HIGH", F.floor(at) + 1).otherwise(F.ceil(at))
    start = F.when(kind == "HIGH", F.lit(0)).otherwise(count)
    return (
        F.when(level.isNull(), start)
        .when(level == -4, count)
        .when(level == -5, F.lit(0))
        .otherwise(F.greatest(F.lit(0), F.least(n, count)))
    )


def state_changes(readings: DataFrame, limits: DataFrame, keys=SERIES, order=ORDER) -> DataFrame:
    """Where a series changes class, per limit.

    The readings are scanned once, whatever the number of limits: a step from
    one reading to the next changes the class of the limits between the two,
    which are a stretch of the range, so a row yields only those.  A series
    starts as NORM, which leaves out the limits it never reaches.  ``limits``
    has one row (param, kind, first, last, step) per swept range.
    """
    t = order[0]
    v = F.col("value")
    # rows come out per limit, and what follows sorts those in the same tasks
    df = balance(readings, keys, t, grows=5.0)
    df = scan(
        df,
        keys,
        order,
        _high=filled_before(_classified("HIGH", v)),
        _low=filled_before(_classified("LOW", v)),
        end_t=overall_max(t),
    )
    df = df.join(limits, "param")
    kind, high = F.col("kind"), F.col("kind") == "HIGH"
    was = F.when(high, F.col("_high")).otherwise(F.col("_low"))
    now = F.when(high, _classified("HIGH", v)).otherwise(_classified("LOW", v))
    count = (F.floor((F.col("last") - F.col("first")) / F.col("step")) + 1).cast("bigint")
    invalid = lambda c: F.coalesce(c.isin(-1.0, -2.0, -3.0), F.lit(False))
    a, b = _reached(kind, was, count), _reached(kind, now, count)
    every = invalid(was) != invalid(now)
    none = now.isNull() | (invalid(was) & invalid(now))
    lo = F.when(every, F.lit(0)).otherwise(F.least(a, b))
    hi = F.when(none, F.lit(0)).when(every, count).otherwise(F.greatest(a, b))
    kept = [c for c in (*keys, *order, slices.SLICE) if c in df.columns]
    moved = df.select(
        *kept, "end_t", "value", "kind", "first", "step", lo.cast("bigint").alias("_lo"), hi.cast("bigint").alias("_hi")
    ).where("_hi > _lo")
    each = moved.withColumn("_i", F.explode(F.sequence(F.col("_lo"), F.col("_hi") - 1)))
    limit = (F.col("first") + F.col("_i") * F.col("step")).cast("bigint")
    state = F.when(high, classify("HIGH", v, F.col("limit"))).otherwise(
        classify("LOW", v, F.col("limit"))
    )
    return each.withColumn("limit", limit).select(*kept, "end_t", "kind", "limit", state.alias("state"))


def threshold_alarms(readings: DataFrame, limits: DataFrame, keys=SERIES, order=ORDER) -> DataFrame:
    """Alarms per series, side and limit: start, stop, xx seconds and bucket.

    Each NORM run opens a group that holds at most one alarm: it starts with
    the first ALARM run and stops where the group ends; XX in between is
    subtracted.  The bucket loses 30 s per NORM second down to zero and gains
    the alarm time: with S the running sum of gains and leaks before an alarm,
    it holds S - min(0, running min S) + gain.
    """
    t = order[0]
    k = [*keys, "kind", "limit"]
    df = state_changes(readings, limits, keys, order)
    norm = F.when(F.col("state") == NORM, 1).otherwise(0)
    df = scan(df, k, order, _next=following(t), _group=running_sum(norm))
    stop = F.coalesce("_next", "end_t")
    span = stop - F.col(t)
    zero = F.lit(0.0)
    groups = df.groupBy(*k, "_group").agg(
        F.min(F.when(F.col("state") == ALARM, F.col(t))).alias("start"),
        F.max(stop).alias("stop"),
        F.sum(F.when(F.col("state") == ALARM, span).otherwise(zero)).alias("_gain"),
        F.sum(F.when(F.col("state") == NORM, span * LEAK_PER_SECOND).otherwise(zero)).alias("_leak"),
        *slices.kept_slice(df),
    )
    groups = scan(
        groups, k, ["_group"], _gained=running_sum("_gain"), _leaked=running_sum("_leak")
    )
    groups = groups.withColumn("_s", F.col("_gained") - F.col("_gain") - F.col("_leaked"))
    groups = scan(groups, k, ["_group"], _floor=running_min("_s"))
    return unsliced(
        groups.where(F.col("start").isNotNull())
        .withColumn("xx", F.col("stop") - F.col("start") - F.col("_gain"))
        .withColumn("bucket", F.col("_s") - F.least(zero, F.col("_floor")) + F.col("_gain"))
        .select(*k, "start", "stop", "xx", "bucket", *[c for c in df.columns if c == slices.SLICE])
    )


def delay_sweep(alarms: DataFrame, keys=SERIES, last=DELAY_MAX, step=DELAY_STEP) -> DataFrame:
    """Alarms and whole seconds over threshold for every delay that has any.

    Alarms are first counted per highest delay they survive, then summed from
    the longest delay down; each count is repeated for the delays it holds for.
    """
    k = [*keys, "kind", "limit"]
    top = F.least(F.floor(F.col("bucket") / step), F.lit(last // step)).cast("int")
    counts = (
        alarms.where("bucket >= 0")
        .groupBy(*k, top.alias("_top"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(F.col("stop") - F.col("start") - F.col("xx")).alias("_time"),
        )
    )
    down = Window.partitionBy(*k).orderBy(F.col("_top").desc())
    upto = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = F.coalesce(F.lead("_top").over(down), F.lit(-1))
    summed = counts.select(
        *k,
        "_top",
        below.alias("_below"),
        F.sum("_n").over(upto).alias("alarms"),
        F.sum("_time").over(upto).cast("bigint").alias("time_over_threshold"),
    )
    delays = F.explode(F.sequence(F.col("_below") + 1, F.col("_top")))
    return summed.withColumn("_d", delays).select(
        *k,
        (F.col("_d") * step).cast("bigint").alias("delay"),
        "alarms",
        "time_over_threshold",
    )


def layered(
    intervals: DataFrame, layers: list[str], keys=("session",), reduced: DataFrame | None = None
) -> DataFrame:
    """Cut the time axis at every interval edge; say which layers hold.

    ``intervals`` has (keys, layer, start, stop).  Rows: start, stop and one
    boolean per layer.
    """
    edges = intervals.where("stop > start").select(
        *keys,
        "layer",
        F.explode(
            F.array(
                F.struct(F.col("start").alias("t"), F.lit(1).alias("d")),
                F.struct(F.col("stop").alias("t"), F.lit(-1).alias("d")),
            )
        ).alias("e"),
    )
    steps = edges.groupBy(*keys, F.col("e.t").alias("t")).agg(
        *[
            F.sum(F.when(F.col("layer") == n, F.col("e.d")).otherwise(0)).alias(f"_{n}")
            for n in layers
        ]
    )
    steps = scan(
        balance(steps, keys, "t", reduced),
        keys,
        ["t"],
        stop=following("t"),
        **{n: running_sum(f"_{n}") for n in layers},
    )
    return steps.where(F.col("stop").isNotNull()).select(
        *keys,
        F.col("t").alias("start"),
        "stop",
        *[(F.col(n) > 0).alias(n) for n in layers],
        *[c for c in steps.columns if c == slices.SLICE],
    )


def where_layers(cut: DataFrame, condition: Column, keys=("session",)) -> DataFrame:
    """Intervals over which a condition on the layers holds."""
    kept = cut.withColumn("_on", condition)
    kept = scan(kept, keys, ["start"], _was=previous("_on"))
    new = F.when(F.col("_on") & ~F.coalesce("_was", F.lit(False)), 1).otherwise(0)
    kept = scan(kept.withColumn("_new", new), keys, ["start"], _id=running_sum("_new"))
    return (
        kept.where("_on")
        .groupBy(*keys, "_id")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
        .drop("_id")
    )


CARDIAC_LAYERS = ["pr_xx", "hr_xx", "pr_drop", "hr_drop", "pr_alarm", "hr_alarm"]


def cardiac_cut(
    intervals: DataFrame, presence: DataFrame, reduced: DataFrame | None = None
) -> DataFrame:
    """Layered time axis per session, with which of the two series exist.

    ``presence`` has one row per session (has_pr, has_hr), so the join key is
    the session and AQE splits a hot one.  ``reduced`` are the readings the
    intervals come from, if their sessions have been checked for size.
    """
    return layered(intervals, CARDIAC_LAYERS, reduced=reduced).join(presence, "session")


def cardiac_invalid(cut: DataFrame) -> DataFrame:
    """Cardiac rate is XX where every existing source is XX."""
    pr, hr = F.col("has_pr"), F.col("has_hr")
    return where_layers(cut, (pr | hr) & (F.col("pr_xx") | ~pr) & (F.col("hr_xx") | ~hr))


def cardiac_dropout(cut: DataFrame) -> DataFrame:
    return where_layers(cut, F.col("pr_drop") & F.col("hr_drop"))


def cardiac_alarms(cut: DataFrame) -> DataFrame:
    """HR alarms count while PR is XX, else PR alarms do."""
    return where_layers(
        cut, F.when(F.col("pr_xx"), F.col("hr_alarm")).otherwise(F.col("pr_alarm"))
    )


def _gap_filled(df: DataFrame, keys, order, value: Column, missing: float) -> DataFrame:
    """Insert a row ``missing`` seconds on where the next reading is later."""
    t = order[0]
    df = scan(df, keys, order, _next=following(t))
    rows = F.array(
        F.struct(F.col(t).alias("_t"), F.lit(0).alias("_ins"), F.col("value").alias("_v")),
        F.when(
            F.col("_next") - F.col(t) > missing,
            F.struct((F.col(t) + missing).alias("_t"), F.lit(1).alias("_ins"), value.alias("_v")),
        ),
    )
    return (
        df.withColumn("_r", F.explode(F.filter(rows, lambda r: r.isNotNull())))
        .withColumn(t, F.col("_r._t"))
        .withColumn("inserted", F.col("_r._ins"))
        .withColumn("value", F.col("_r._v"))
        .drop("_r", "_next")
    )


def gap_filled(readings: DataFrame, default: float, missing=60.0, keys=("session",), order=ORDER):
    return unsliced(
        _gap_filled(
            balance(readings, keys, order[0]), keys, order, F.lit(float(default)), float(missing)
        )
    )


def _alert_runs(df: DataFrame, keys, order, alert: Column, delay: float) -> DataFrame:
    """Alert runs of at least ``delay``: count and time beyond the delay.

    A run ends at the first row after it, or at the last row of the period; a
    period that is in alert from start to end has no change and no run.
    """
    t = order[0]
    df = df.withColumn("_a", alert)
    df = scan(df, keys, order, _was=previous("_a"), _next=following(t))
    head = F.col("_a") & ~F.coalesce("_was", F.lit(False))
    change = F.coalesce(F.col("_a") != F.col("_was"), F.lit(False))
    df = df.withColumn("_head", head.cast("int")).withColumn("_change", change.cast("int"))
    df = scan(df, keys, order, _run=running_sum("_head"), _moves=overall_max("_change"))
    runs = (
        df.where("_a and _moves = 1")
        .groupBy(*keys, "_run")
        .agg((F.max(F.coalesce("_next", t)) - F.min(t)).alias("_len"))
        .where(F.col("_len") >= delay)
    )
    return runs


def drift_alerts(
    readings: DataFrame,
    calibrations: DataFrame,
    delay: float,
    percent: float = 0.3,
    missing: float = 60.0,
    key: str = "session",
) -> DataFrame:
    """Alerts where the pressure drifts from its calibration value.

    ``readings`` (session, t, seq, value), ``calibrations`` (session, t, value).
    Per calibration period: XX counts as the calibration value, ++ as 240, --
    as 40, and a step over ``missing`` seconds returns to the calibration value.
    """
    from .asof import last_before

    cal = calibrations.select(
        key, "t", F.monotonically_increasing_id().alias("seq"), F.col("value").alias("cal")
    ) if "seq" not in calibrations.columns else calibrations.select(
        key, "t", "seq", F.col("value").alias("cal")
    )
    rows = readings.select(key, "t").unionByName(cal.select(key, "t"))
    checked = balance(rows, [key], "t")
    hit = last_before(readings, cal, [key], ["cal"], inclusive=True, reduced=checked)
    hit = hit.where(F.col("match").isNotNull()).select(
        key, "t", "seq", "value", F.col("match.t").alias("cal_t"), F.col("match.cal").alias("cal")
    )
    v = F.col("value")
    invalid = v.isin(-1.0, -2.0, -6.0, -7.0, -8.0, -9.0, -10.0)
    hit = hit.withColumn(
        "value", F.when(invalid, F.col("cal")).when(v == -4, 240.0).when(v == -5, 40.0).otherwise(v)
    )
    keys = [key, "cal_t"]
    hit = _gap_filled(balance(hit, keys, "t", checked), keys, ["t", "seq"], F.col("cal"), float(missing))
    drift = (F.col("value") >= F.col("cal") * (1.0 + percent)) | (
        F.col("value") <= F.col("cal") * (1.0 - percent)
    )
    runs = _alert_runs(hit, keys, ["t", "inserted", "seq"], drift, delay)
    return runs.groupBy(key).agg(
        F.count(F.lit(1)).alias("alerts"), F.sum(F.col("_len") - delay).alias("seconds")
    )


def lost_alerts(readings: DataFrame, delay: float, missing: float = 60.0, key="session") -> DataFrame:
    """Alerts where the reading is lost (XX); a long step counts as valid (100)."""
    v = F.col("value")
    df = readings.withColumn("value", F.when(v == -4, 240.0).when(v == -5, 40.0).otherwise(v))
    df = _gap_filled(balance(df, [key], "t"), [key], ["t", "seq"], F.lit(100.0), float(missing))
    runs = _alert_runs(df, [key], ["t", "inserted", "seq"], F.col("value") < 0, delay)
    return runs.groupBy(key).agg(
        F.count(F.lit(1)).alias("alerts"), F.sum(F.col("_len") - delay).alias("seconds")
    )
