"""Channels of unequal rates on one tick grid with one time axis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import NO_SAMPLE
from .slices import balance, filled, following, refilled, refilled_after, scan, unsliced
from .waveform import BLOCK

# What stands for a saturated optical sample, for a missing seismic or
# pressure sample, and the longest block (three hours of ticks).
SATURATED = 645_000_000
NO_VALUE = 2**32 - 1
LONGEST_BLOCK = 5_400_000
STRIP = 10_000  # ticks laid out at once


def first_samples(samples: DataFrame, keys=BLOCK) -> DataFrame:
    """One sample per channel and tick: the first that came (lowest ``seq``)."""
    return samples.groupBy(*keys, "lead", "sn").agg(
        F.min_by(F.struct("t", "value"), "seq").alias("_first")
    ).select(*keys, "lead", "sn", "_first.t", "_first.value")


def resampled(samples: DataFrame, fast: str, slow: Sequence[str], keys=BLOCK) -> DataFrame:
    """Slow channels at the ticks of a fast one, by straight lines between their samples.

    Rows (keys, sn, lead, t, seq, value) come back for the fast channel as they are
    and for each slow one at every fast tick, with the time of that tick; before the
    first and after the last slow sample the value is null.
    """
    once = first_samples(samples.where(F.col("lead").isin(fast, *slow)), keys)
    quick = once.where(F.col("lead") == fast)
    ticks = quick.select(
        *keys, F.explode(F.array(*[F.lit(c) for c in slow])).alias("lead"), "sn", "t",
        F.lit(None).cast("double").alias("value"), F.lit(1).alias("_tick"),
    )
    own = once.where(F.col("lead") != fast).select(
        *keys, "lead", "sn", "t", F.col("value").cast("double").alias("value"), F.lit(0).alias("_tick")
    )
    both = own.unionByName(ticks)
    sample = F.when(F.col("_tick") == 0, F.struct("sn", "value"))
    df = scan(
        balance(both, [*keys, "lead"], "sn"), [*keys, "lead"], ["sn", "_tick"],
        _before=filled(sample), _after=refilled(sample),
    )
    value = F.when(F.col("_before.sn") == F.col("sn"), F.col("_before.value")).otherwise(_line("value"))
    lines = unsliced(df).where("_tick = 1").select(*keys, "sn", "lead", "t", value.alias("value"))
    quick = quick.select(*keys, "sn", "lead", "t", F.col("value").cast("double").alias("value"))
    return quick.unionByName(lines).withColumn("seq", F.lit(0))


def _line(name: str) -> Column:
    before, after = F.col("_before"), F.col("_after")
    rise = (after[name] - before[name]) / (after["sn"] - before["sn"])
    return before[name] + (F.col("sn") - before["sn"]) * rise


def merged_channels(
    samples: DataFrame,
    channels: Sequence[str],
    missing: float = NO_SAMPLE,
    unknown: float | None = None,
    max_ticks: int | None = LONGEST_BLOCK,
    drop_empty: bool = False,
    keys=BLOCK,
) -> DataFrame:
    """Full outer merge of channels on the ticks of a block: (keys, sn, t, one column a channel).

    ``samples`` has (keys, sn, lead, t, seq, value); of repeated ticks the first sample
    counts.  A tick without a sample of a channel holds ``missing``, one whose
    sample has no value ``unknown`` (``missing`` if not given).  Its time is that of the
    last channel with one, otherwise on the line between the nearest known times,
    or the nearest where there is none on one side.  ``drop_empty`` drops ticks at which
    every channel is missing; blocks over ``max_ticks`` are left out.
    """
    own = samples.where(F.col("lead").isin(*channels))
    cell = lambda c: F.when(F.col("lead") == c, F.struct("t", "value"))
    wide = own.groupBy(*keys, "sn").agg(
        *[F.min_by(cell(c), F.when(F.col("lead") == c, F.col("seq"))).alias(f"_c{i}") for i, c in enumerate(channels)]
    )
    wide = wide.where(F.col("sn").isNotNull())
    if max_ticks is not None:
        wide = wide.join(refused_blocks(own, max_ticks, keys).hint("merge"), list(keys), "left_anti")
    known = F.coalesce(*[F.col(f"_c{i}.t") for i in reversed(range(len(channels)))])
    df = wide.withColumn("_t", known)
    place = F.when(F.col("_t").isNotNull(), F.struct("sn", F.col("_t").alias("t")))
    df = unsliced(scan(
        balance(df, keys, "sn"), keys, ["sn"],
        _before=filled(place), _after=refilled(place), _later=refilled_after(place), _next=following("sn"),
    ))
    df = _with_ticks_between(df, [f"_c{i}" for i in range(len(channels))])
    t = F.coalesce("_t", _line("t"), F.col("_before.t"), F.col("_after.t"))
    value = lambda i: F.when(F.col(f"_c{i}").isNull(), F.lit(missing)).otherwise(
        F.coalesce(F.col(f"_c{i}.value"), F.lit(missing if unknown is None else unknown))
    )
    out = df.select(*keys, "sn", t.alias("t"), *[value(i).alias(c) for i, c in enumerate(channels)])
    if drop_empty:
        out = out.where(~F.forall(F.array(*[F.col(c) == missing for c in channels]), lambda x: x))
    return out


def _with_ticks_between(df: DataFrame, cells: Sequence[str]) -> DataFrame:
    """Each row, and one without samples for every tick up to the next row.

    What a missing tick needs (the known times around it) is in the row before it, so
    ticks are made from rows that are in order already and none of them is sorted; they
    come in strips, so no array holds a whole gap.
    """
    gap = F.col("_next") - F.col("sn") > 1
    strips = F.when(gap, F.sequence(F.col("sn") + 1, F.col("_next") - 1, F.lit(STRIP).cast("bigint")))
    place = F.concat(F.array(F.col("sn")), F.coalesce(strips, F.array().cast("array<bigint>")))
    df = df.withColumn("_s", F.explode(place))
    own = F.col("_s") == F.col("sn")
    last = F.when(own, F.col("_s")).otherwise(F.least(F.col("_s") + (STRIP - 1), F.col("_next") - 1))
    df = df.withColumn("_tick", F.explode(F.sequence(F.col("_s"), last)))
    own = F.col("_tick") == F.col("sn")
    return df.select(
        *[F.when(own, F.col(c)).alias(c) if c in (*cells, "_t") else F.col(c) for c in df.columns if c not in ("sn", "_after", "_tick", "_s", "_later", "_next")],
        F.col("_tick").alias("sn"),
        F.when(own, F.col("_after")).otherwise(F.col("_later")).alias("_after"),
    )


def refused_blocks(samples: DataFrame, max_ticks: int = LONGEST_BLOCK, keys=BLOCK) -> DataFrame:
    """Blocks that a merge leaves out as too long, with their ticks."""
    span = samples.groupBy(*keys).agg((F.max("sn") - F.min("sn")).alias("ticks"))
    return span.where(F.col("ticks") > max_ticks)


def merged_optical(samples: DataFrame, fast: str, slow: Sequence[str], keys=BLOCK) -> DataFrame:
    """Optical channels with the slow ones raised to the rate of the fast one; no value counts as saturated."""
    raised = resampled(samples, fast, slow, keys)
    return merged_channels(raised, [fast, *slow], NO_SAMPLE, SATURATED, None, keys=keys)


def merged_seismic(samples: DataFrame, channels: Sequence[str], keys=BLOCK) -> DataFrame:
    return merged_channels(samples, channels, NO_VALUE, keys=keys)


def merged_pressure(samples: DataFrame, channels: Sequence[str], keys=BLOCK) -> DataFrame:
    """Pressure channels; ticks at which all are missing are dropped."""
    return merged_channels(samples, channels, NO_VALUE, drop_empty=True, keys=keys)
