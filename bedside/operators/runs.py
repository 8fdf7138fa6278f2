"""Epochs, dropouts, state runs, islands and interval merging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import slices
from .slices import balance, following, previous, running_max, running_sum, scan, unsliced

SERIES = ("session", "param")
ORDER = ("t", "seq")


def is_invalid(value: Column) -> Column:
    """XX: no usable reading (codes -1, -2, -3)."""
    return (value < 0) & (value > -4)


def marked(
    readings: DataFrame,
    rate: Column | float,
    slop: float = 0.1,
    flag: Column | None = None,
    keys: Sequence[str] = SERIES,
    order: Sequence[str] = ORDER,
    sn: str = "sn",
) -> DataFrame:
    """Readings with their epoch, gap and run marks (one scan of the series).

    ``next_t`` is the following time inside the same epoch, ``gap`` says that
    the step to it is a dropout, ``gap_head`` that a merged dropout starts
    here; ``flagged``/``run_head`` do the same for the state in ``flag``.
    """
    t = order[0]
    flag = is_invalid(F.col("value")) if flag is None else flag
    df = balance(readings, keys, t) if slices.SLICE not in readings.columns else readings
    step = F.struct(F.col(t).alias("t"), F.col(sn).alias("sn"), flag.alias("flag"))
    df = scan(df, keys, order, _before=previous(step), _after=following(step))
    here_t, here_sn = F.col(t), F.col(sn)
    reset = F.coalesce(here_sn < F.col("_before.sn"), F.lit(False))
    prev_t = F.when(~reset, F.col("_before.t"))
    next_t = F.when(F.col("_after.sn") >= here_sn, F.col("_after.t"))
    limit = rate + F.lit(slop) if isinstance(rate, Column) else F.lit(float(rate) + slop)
    gap = F.coalesce(next_t - here_t > limit, F.lit(False))
    prev_gap = F.coalesce(here_t - prev_t > limit, F.lit(False))
    flagged = F.coalesce(flag, F.lit(False))
    prev_flag = F.coalesce(F.when(~reset, F.col("_before.flag")), F.lit(False))
    return df.select(
        "*",
        reset.alias("reset"),
        next_t.alias("next_t"),
        gap.alias("gap"),
        (gap & ~prev_gap).alias("gap_head"),
        flagged.alias("flagged"),
        (flagged & ~prev_flag).alias("run_head"),
    ).drop("_before", "_after")


def numbered(marks: DataFrame, keys=SERIES, order=ORDER) -> DataFrame:
    """Add the epoch number and ids of the merged gap and run a row is in."""
    one = lambda c: F.when(F.col(c), 1).otherwise(0)
    df = scan(
        marks,
        keys,
        order,
        epoch=running_sum(one("reset")),
        gap_id=running_sum(one("gap_head")),
        run_id=running_sum(one("run_head")),
    )
    return df.withColumn("gap_id", F.when(F.col("gap"), F.col("gap_id"))).withColumn(
        "run_id", F.when(F.col("flagged"), F.col("run_id"))
    )


def epochs(readings: DataFrame, keys=SERIES, order=ORDER, sn="sn") -> DataFrame:
    """Number the stretches between resets (a falling sequence number)."""
    df = balance(readings, keys, order[0])
    df = scan(df, keys, order, _sn=previous(sn))
    fell = F.when(F.col(sn) < F.col("_sn"), 1).otherwise(0)
    return unsliced(scan(df, keys, order, epoch=running_sum(fell)).drop("_sn"))


def dropouts(numbers: DataFrame, rate: Column | float, keys=SERIES, t="t") -> DataFrame:
    """Merged dropout intervals, with the state run each lies wholly inside."""
    rate = rate if isinstance(rate, Column) else F.lit(float(rate))
    return (
        numbers.where("gap")
        .groupBy(*keys, "epoch", "gap_id")
        .agg(
            F.min(F.col(t) + rate).alias("start"),
            F.max("next_t").alias("stop"),
            F.count(F.lit(1)).alias("_n"),
            F.count("run_id").alias("_in"),
            F.min("run_id").alias("_r0"),
            F.max("run_id").alias("_r1"),
        )
        .withColumn(
            "inside_run",
            F.when((F.col("_n") == F.col("_in")) & (F.col("_r0") == F.col("_r1")), F.col("_r0")),
        )
        .drop("_n", "_in", "_r0", "_r1", "gap_id")
    )


def state_runs(numbers: DataFrame, rate: Column | float, keys=SERIES, t="t") -> DataFrame:
    """Runs of the flagged state with the dropout time wholly inside each."""
    runs = (
        numbers.where("flagged")
        .groupBy(*keys, "epoch", "run_id")
        .agg(
            F.min(t).alias("start"),
            F.max(F.coalesce("next_t", t)).alias("stop"),
            F.count(F.lit(1)).alias("_n"),
            F.count("next_t").alias("_closed"),
        )
        .where((F.col("_n") > 1) | (F.col("_closed") > 0))
        .drop("_n", "_closed")
    )
    inner = (
        dropouts(numbers, rate, keys, t)
        .where(F.col("inside_run").isNotNull())
        .groupBy(*keys, "epoch", F.col("inside_run").alias("run_id"))
        .agg(F.sum(F.col("stop") - F.col("start")).alias("dropout"))
    )
    return runs.join(inner, [*keys, "epoch", "run_id"], "left").withColumn(
        "dropout", F.coalesce("dropout", F.lit(0.0))
    )


def changes(df: DataFrame, keys, order, column: Column) -> DataFrame:
    """Rows whose ``column`` differs from the row before (first row kept)."""
    df = balance(df, keys, order[0]).withColumn("_v", F.struct(column.alias("v")))
    df = scan(df, keys, order, _p=previous("_v"))
    return unsliced(df.where(~F.col("_v").eqNullSafe(F.col("_p"))).drop("_v", "_p"))


def islands(df: DataFrame, keys, order, label: str, begin: str, end: str) -> DataFrame:
    """Stretches of consecutive rows with one ``label``: first begin, last end."""
    df = scan(balance(df, keys, order[0]), keys, order, _p=previous(F.struct(label)))
    new = F.when(F.struct(label).eqNullSafe(F.col("_p")), 0).otherwise(1)
    df = scan(df.withColumn("_new", new).drop("_p"), keys, order, island=running_sum("_new"))
    return df.groupBy(*keys, "island", label).agg(
        F.min(begin).alias("start"), F.max(end).alias("stop"), F.count(F.lit(1)).alias("n")
    )


def merge_intervals(df: DataFrame, keys, begin: str, end: str, touching: bool = False) -> DataFrame:
    """Union of overlapping ``[begin, end)`` rows; touching ones stay apart."""
    df = balance(df, keys, begin)
    df = df.groupBy(*keys, begin).agg(
        F.max(end).alias(end), F.count(F.lit(1)).alias("_n"), *slices.kept_slice(df)
    )
    df = scan(df, keys, [begin], _reach=running_max(end))
    df = scan(df, keys, [begin], _before=previous("_reach"))
    apart = F.col(begin) > F.col("_before") if touching else F.col(begin) >= F.col("_before")
    new = F.when(F.coalesce(apart, F.lit(True)), 1).otherwise(0)
    df = scan(df.withColumn("_new", new), keys, [begin], _group=running_sum("_new"))
    return (
        df.groupBy(*keys, "_group")
        .agg(F.min(begin).alias(begin), F.max(end).alias(end), F.sum("_n").alias("merged"))
        .drop("_group")
    )


def rhythm_intervals(rhythm: DataFrame, kind: str, from_start: bool = False) -> DataFrame:
    """Rhythm code rows widened to look-back intervals and merged per session.

    Fixed values: ticks of look-back and the code test of each rhythm.
    """
    windows = {"VFIB": 12288, "AFIB": 98000, "ASYS": 1000}
    code, sn = F.col("code"), F.col("sn")
    small = (code > 0) & (code < 10)
    hit = {
        "VFIB": small & (code.bitwiseAND(2) > 0),
        "AFIB": code == 1,
        "ASYS": small & (code.bitwiseAND(4) > 0),
    }[kind]
    width = windows[kind]
    if kind == "ASYS":
        begin, end = sn - width, sn
    elif from_start:
        begin, end = F.col("start_sn"), sn + 500
    else:
        begin, end = F.greatest(sn - width, F.lit(0)), sn + 500
    rows = rhythm.where(hit).select(
        "session", begin.cast("bigint").alias("begin"), end.cast("bigint").alias("end")
    )
    return merge_intervals(rows, ["session"], "begin", "end").withColumn("tag", F.lit(kind))


def marks_to_intervals(
    marks: DataFrame,
    begin: Column,
    end: Column,
    tags: dict[str, str],
    symbols: Sequence[str] = ("+", "[", "]"),
    keys=("session",),
    order=("t", "seq"),
) -> DataFrame:
    """Annotation marks to state intervals clipped to ``[begin, end]``.

    Only state symbols count (rhythm change, start and stop of flutter); each
    holds until the next.  ``tags`` names the state of a mark, else OTHER.
    """
    t = order[0]
    tag = F.lit("OTHER")
    for mark, name in tags.items():
        tag = F.when(F.col("mark") == mark, F.lit(name)).otherwise(tag)
    df = marks.where(F.col("symbol").isin(*symbols)).withColumn("tag", tag)
    df = df.withColumn("_b", begin).withColumn("_e", end).where(F.col(t) <= F.col("_e"))
    df = scan(balance(df, keys, t), keys, order, _next=following(t))
    lo = F.greatest(F.col(t), F.col("_b"))
    hi = F.least(F.coalesce("_next", "_e"), F.col("_e"))
    return df.select(*keys, lo.alias("start"), hi.alias("stop"), "tag").where("start < stop")


def apply_delays(intervals: DataFrame, on_delay, off_delay, keys=("session",)) -> DataFrame:
    """On/off delays on disjoint intervals.

    An interval longer than the on-delay starts an alarm ``on_delay`` late and
    ends it ``off_delay`` late; a shorter one only prolongs an alarm it
    reaches.  Short intervals that lead a connected stretch reach nothing, so
    they are dropped until every stretch is led by a long one.
    """
    from ..session import durable

    df = intervals.select(
        *keys,
        "begin",
        (F.col("end") + F.lit(off_delay)).alias("ext"),
        ((F.col("end") - F.col("begin")) > F.lit(on_delay)).alias("long"),
    )
    df = balance(df, keys, "begin")
    while True:
        df = scan(df, keys, ["begin"], _reach=running_max("ext"))
        df = scan(df, keys, ["begin"], _before=previous("_reach"))
        new = F.when(F.col("begin") < F.col("_before"), 0).otherwise(1)
        df = scan(df.withColumn("_new", new), keys, ["begin"], _group=running_sum("_new"))
        led = scan(df, [*keys, "_group"], ["begin"], _led=running_max(F.col("long").cast("int")))
        led = durable(led)
        kept = led.where("_led = 1")
        if led.where("_led = 0").isEmpty():
            return (
                kept.groupBy(*keys, "_group")
                .agg((F.min("begin") + F.lit(on_delay)).alias("begin"), F.max("ext").alias("end"))
                .drop("_group")
            )
        df = kept.drop("_reach", "_before", "_new", "_group", "_led")
