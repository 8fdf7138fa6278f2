"""Histograms of durations, values and codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import DURATION_EDGES, LAST_BIN_LABEL
from .slices import balance, overall_max, running_sum, scan, unsliced


def duration_bin(seconds: Column) -> Column:
    """Upper edge of the half-open bin a duration falls in (7201 for the last)."""
    labels = [*DURATION_EDGES[1:], LAST_BIN_LABEL]
    out = F.lit(None).cast("int")
    for low, label in zip(DURATION_EDGES, labels):
        out = F.when(seconds >= low, F.lit(label)).otherwise(out)
    return out


def duration_histogram(rows: DataFrame, keys, seconds: Column, **extra: Column) -> DataFrame:
    """Count and summed whole seconds per duration bin; empty bins are absent."""
    named = rows.withColumn("_d", seconds).where("_d >= 0")
    return (
        named.groupBy(*keys, duration_bin(F.col("_d")).cast("bigint").alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("frequency"),
            F.sum("_d").cast("bigint").alias("seconds"),
            *[F.sum(c).cast("bigint").alias(n) for n, c in extra.items()],
        )
    )


def value_histogram(readings: DataFrame, ranges: DataFrame, keys=("session", "param")) -> DataFrame:
    """Counts of whole values within the range of each parameter.

    ``ranges`` (param, low, high) has one row per parameter.
    """
    return (
        readings.where("value > -1")
        .withColumn("bin", F.col("value").cast("bigint"))
        .join(ranges, "param")
        .where(F.col("bin").between(F.col("low"), F.col("high")))
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )


def code_histogram(df: DataFrame, keys, code: Column) -> DataFrame:
    return df.groupBy(*keys, code.cast("bigint").alias("code")).agg(
        F.count(F.lit(1)).alias("frequency")
    )


def alarm_histogram(alarms: DataFrame, keys=("session",)) -> DataFrame:
    """Alarms per code: rows of one start sequence are one alarm."""
    return alarms.groupBy(*keys, "code").agg(F.countDistinct("start_sn").alias("alarms"))


def fixed_width_histogram(df: DataFrame, keys, value: Column, low=-1, width=10, bins=200) -> DataFrame:
    """Equal bins from ``low``; empty bins kept, last bin closed on the right.

    The histogram has ``bins`` rows per key group, so the grid is laid out from
    one array per group.
    """
    high = low + width * bins
    index = F.when(value == high, F.lit(bins - 1)).otherwise(F.floor((value - low) / width))
    counts = (
        df.withColumn("_i", index.cast("int"))
        .withColumn("_in", (value >= low) & (value <= high))
        .groupBy(*keys, F.when(F.col("_in"), F.col("_i")).alias("_i"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    grids = counts.groupBy(*keys).agg(
        F.map_from_entries(
            F.collect_list(F.when(F.col("_i").isNotNull(), F.struct("_i", "_n")))
        ).alias("_m")
    )
    return grids.select(
        *keys, "_m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("_i")
    ).select(
        *keys,
        (F.lit(low) + F.col("_i") * width).cast("bigint").alias("bin"),
        F.coalesce(F.col("_m")[F.col("_i")], F.lit(0)).cast("bigint").alias("frequency"),
    )


def exact_median(df: DataFrame, keys, value: str) -> DataFrame:
    """Median per group from value counts, so no group is gathered in one task.

    Counts per (group, value) are summed map-side first; the median is read
    off their running total.
    """
    checked = balance(df, keys, value)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return weighted_median(counts, keys, value, "_n", checked)


def robust_spread(df: DataFrame, keys, value: str) -> DataFrame:
    """Median absolute deviation per group."""
    mid = exact_median(df, keys, value).select(*keys, F.col("median").alias("_m"))
    away = (
        df.groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_n"))
        .join(mid, list(keys))
        .withColumn("_away", F.abs(F.col(value) - F.col("_m")))
    )
    checked = balance(df, keys, value)
    return weighted_median(away, [*keys, "_m"], "_away", "_n", checked).select(
        *keys, F.col("_m").alias("median"), F.col("median").alias("mad")
    )


def weighted_median(
    counts: DataFrame, keys, value: str, weight: str, reduced: DataFrame | None = None
) -> DataFrame:
    """Median of values with counts; ``reduced`` holds the rows that were counted."""
    c = counts.groupBy(*keys, value).agg(F.sum(weight).alias("_w"))
    c = scan(balance(c, keys, value, reduced), keys, [value], _c=running_sum("_w"))
    c = scan(c, keys, [value], _all=overall_max("_c"))
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    holds = lambda k: (F.col("_c") >= k) & (F.col("_c") - F.col("_w") < k)
    return c.groupBy(*keys).agg(
        (
            (F.max(F.when(holds(low), F.col(value))) + F.max(F.when(holds(high), F.col(value)))) / 2
        ).alias("median")
    )


def standardised(df: DataFrame, keys, value: str) -> DataFrame:
    """Value minus the group mean over the population deviation; null in a group without spread.

    The moments are one partially aggregated row per group; joining them back
    on a hot group is left to the skew handling of adaptive execution.
    """
    moments = df.groupBy(*keys).agg(
        F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_sd")
    )
    z = F.when(F.col("_sd") > 0, (F.col(value) - F.col("_mean")) / F.col("_sd"))
    return df.join(moments, list(keys)).withColumn("z", z).drop("_mean", "_sd")


def collected(df: DataFrame, keys, value: str) -> DataFrame:
    """Results of each group in order, nulls skipped: one row per place in the list.

    Lists stay in rows, so a group of any size is never gathered.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, value)
    rows = balance(rows, keys, value)
    return unsliced(scan(rows, keys, [value], place=running_sum(F.lit(1).cast("bigint"))))
