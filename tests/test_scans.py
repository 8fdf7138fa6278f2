"""Scans over slices give what one window gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from bedside.operators import slices
from bedside.operators.slices import SLICE, SLICE_ROWS, TASK_ROWS, balance, scan

KINDS = [
    "previous", "following", "running_sum", "running_max", "running_min", "filled", "filled_before",
    "refilled", "refilled_after", "overall_max", "overall_min",
]


def frame(spark):
    # series 0 holds two thirds of the rows; a null key and null values take part
    return spark.range(600).select(
        F.when(F.col("id") % 3 < 2, 0).when(F.col("id") % 2 == 0, 1).alias("k"),
        ((F.col("id") * 37) % 601).cast("double").alias("t"),
        F.when(F.col("id") % 4 != 0, (F.col("id") * 13) % 29).alias("v"),
    )


def test_every_scan_kind_is_exact(spark):
    def run():
        df = balance(frame(spark), ["k"], "t")
        specs = {f"x_{n}": getattr(slices, n)("v") for n in KINDS}
        out = scan(df, ["k"], ["t"], **specs)
        rows = out.select("k", "t", *specs).collect()
        return SLICE in df.columns, sorted(map(str, rows))

    was_sliced, whole = run()
    assert not was_sliced
    spark.conf.set(SLICE_ROWS, "20")
    try:
        is_sliced, cut = run()
    finally:
        spark.conf.unset(SLICE_ROWS)
    assert is_sliced
    assert cut == whole


def test_only_big_series_are_cut(spark):
    spark.conf.set(SLICE_ROWS, "150")
    try:
        df = balance(frame(spark), ["k"], "t")
        cut = df.where(F.col(SLICE).isNotNull()).select("k").distinct().collect()
        sizes = df.where("k = 0").groupBy(SLICE).count().collect()
    finally:
        spark.conf.unset(SLICE_ROWS)
    assert [r.k for r in cut] == [0]
    assert max(r["count"] for r in sizes) <= 200


def test_same_instants_stay_in_order(spark):
    df = spark.createDataFrame([(1, 5.0, i, float(i)) for i in range(10)], "k int, t double, seq int, v double")
    spark.conf.set(SLICE_ROWS, "3")
    try:
        out = scan(balance(df, ["k"], "t"), ["k"], ["t", "seq"], p=slices.previous("v")).orderBy("seq")
        assert [r.p for r in out.collect()] == [None, *map(float, range(9))]
    finally:
        spark.conf.unset(SLICE_ROWS)


def test_a_burst_is_spread(spark):
    # nine tenths of the series fall into a hundredth of its time
    df = spark.range(1000).select(
        F.lit(1).alias("k"),
        F.when(F.col("id") % 10 < 9, 500 + F.col("id") / 100).otherwise(F.col("id")).cast("double").alias("t"),
    )
    spark.conf.set(SLICE_ROWS, "100")
    try:
        sizes = [r["count"] for r in balance(df, ["k"], "t").groupBy(SLICE).count().collect()]
    finally:
        spark.conf.unset(SLICE_ROWS)
    assert sum(sizes) == 1000 and len(sizes) <= 11 and max(sizes) <= 200


def test_series_are_dealt_by_their_rows(spark):
    """Spark merges small partitions; what a task sorts must not grow with the table."""

    def run():
        df = balance(frame(spark), ["k"], "t")
        out = scan(df, ["k"], ["t"], p=slices.previous("v"), s=slices.running_sum("v"))
        return df.rdd.getNumPartitions(), sorted(map(str, out.collect()))

    _, whole = run()
    spark.conf.set(TASK_ROWS, "20")
    try:
        parts, dealt = run()
        grown = balance(frame(spark), ["k"], "t", grows=2.0).rdd.getNumPartitions()
    finally:
        spark.conf.unset(TASK_ROWS)
    assert parts == 30 and grown == 60 and dealt == whole
