"""Windowed export of the numeric readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import local_text
from ..functions.codes import joined_text
from ..operators.asof import first_after

NUMERICS = ["SPO2", "HR", "PR", "RR", "CNIBP_SYS", "CNIBP_DIA", "CNIBP_MAP", "BP_SYS", "BP_DIA", "BP_MAP"]


def value_text(value: Column) -> Column:
    """Median of the valid readings of a group as text, else their state."""
    valid = F.when(value > -1, value)
    none_valid = F.count(valid) == 0
    invalid = F.max(((value < 0) & (value > -4)).cast("int")) == 1
    over = F.max((value == -4).cast("int")) == 1
    return (
        F.when(~none_valid, F.median(valid).cast("bigint").cast("string"))
        .when(invalid, "XX")
        .when(over, "++")
        .otherwise("--")
    )


def windowed_values(readings: DataFrame, spans: DataFrame, window: float, keys=("session",)) -> DataFrame:
    """Text of each window and series: median of the valid readings or their state."""
    rows = readings.join(spans.select(*keys, "t0"), list(keys))
    index = F.floor((F.col("t") - F.col("t0")) / window)
    return rows.groupBy(*keys, "param", index.alias("window")).agg(value_text(F.col("value")).alias("text"))


def time_spans(readings: DataFrame, keys=("session",)) -> DataFrame:
    return readings.groupBy(*keys).agg(
        F.floor(F.min("t")).cast("double").alias("t0"), F.ceil(F.max("t")).cast("double").alias("t1")
    )


def windowed_export(
    readings: DataFrame,
    params: list[str] | None = None,
    window: float = 15.0,
    texts: dict[str, tuple[DataFrame, DataFrame]] | None = None,
    devices: DataFrame | None = None,
    zone: str | Column | None = None,
    keep_empty: bool = True,
    keys=("session",),
) -> DataFrame:
    """One row per window from the first second to the last of a session.

    ``texts`` adds columns of joined code texts: name -> (rows with t and code,
    dimension code/text).  ``devices`` (keys, t = end of the block, device)
    gives the device in force.  The label time is the window's centre.
    """
    params = params or NUMERICS
    texts = texts or {}
    times = readings.where(F.col("param").isin(*params)).select(*keys, "t")
    for rows, _ in texts.values():
        times = times.unionByName(rows.select(*keys, "t"))
    spans = time_spans(times, keys)
    count = F.ceil((F.col("t1") + window - F.col("t0")) / window)
    grid = spans.select(
        *keys, "t0", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)).alias("window")
    )
    cells = windowed_values(readings.where(F.col("param").isin(*params)), spans, window, keys)
    wide = cells.groupBy(*keys, "window").agg(
        *[F.max(F.when(F.col("param") == p, F.col("text"))).alias(p.lower()) for p in params]
    )
    out = grid.join(wide, [*keys, "window"], "left")
    for name, (rows, dimension) in texts.items():
        placed = rows.join(spans.select(*keys, "t0"), list(keys)).withColumn(
            "window", F.floor((F.col("t") - F.col("t0")) / window)
        )
        joined = joined_text(placed, dimension, [*keys, "window"]).withColumnRenamed("text", name)
        out = out.join(joined, [*keys, "window"], "left")
    filled = [p.lower() for p in params] + list(texts)
    if not keep_empty:
        out = out.where(F.coalesce(*filled).isNotNull())
    out = out.withColumn("t", F.col("t0") + F.col("window") * window)
    if devices is not None:
        last = devices.groupBy(*keys).agg(F.max_by("device", "t").alias("_last"))
        out = first_after(out, devices, list(keys), ["device"], inclusive=True)
        out = out.join(last, list(keys), "left").withColumn(
            "device", F.coalesce("match.device", "_last")
        ).drop("match", "_last")
        filled = ["device", *filled]
    centre = F.col("t") + window / 2
    label = local_text(centre, zone) if zone is not None else centre.cast("bigint").cast("string")
    return out.select(*keys, label.alias("time"), *filled)
