"""Device logs stored as tab-separated text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: where a line names its device and date.
HEAD = r"deviceID=([0-9]{6}).*Date=([0-9]{2} [A-Z][a-z]{2} [0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2})"


def parsed_lines(
    lines: DataFrame, column: str = "value", device: int | None = None, head_pattern: str = HEAD
) -> DataFrame:
    """Lines to (device_id, at, fields); lines without both are dropped.

    ``head_pattern`` finds the device id and the date in the first field.
    """
    parts = F.split(F.col(column), "\t")
    head = F.get(parts, 0)
    df = lines.withColumn("_parts", parts).where(F.size("_parts") > 1).select(
        *[c for c in lines.columns if c != column],
        F.regexp_extract(head, head_pattern, 1).try_cast("bigint").alias("device_id"),
        F.try_to_timestamp(F.regexp_extract(head, head_pattern, 2), F.lit("dd MMM yyyy HH:mm:ss")).alias("at"),
        F.transform(F.slice("_parts", F.lit(2), F.size("_parts") - 1), lambda x: _trim(x)).alias("fields"),
    )
    df = df.where(F.col("device_id").isNotNull() & F.col("at").isNotNull())
    return df if device is None else df.where(F.col("device_id") == device)


def _trim(x: Column) -> Column:
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def read_log_text(spark: SparkSession, path: str, device: int | None = None) -> DataFrame:
    """Read gzip or plain log files; one gzip file is one task, files run in parallel."""
    return parsed_lines(spark.read.text(path), device=device)
