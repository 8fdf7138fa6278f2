"""Windowed export on a stream of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.export import value_text


def export_stream(readings: DataFrame, window: str = "15 seconds", lateness: str = "1 minute") -> DataFrame:
    """Text of each window and series, out once the watermark passes the window.

    Windows are aligned to the clock; windows without readings do not appear.
    """
    return (
        readings.withWatermark("ts", lateness)
        .groupBy("session", "param", F.window("ts", window).alias("w"))
        .agg(value_text(F.col("value")).alias("text"))
        .select("session", "param", F.col("w.start").alias("start"), "text")
    )
