"""Streams give what the batch operators give."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from bedside.operators import alarms as al
from bedside.operators import runs
from bedside.streaming.alarms import alarm_stream
from bedside.streaming.dropouts import dropout_stream
from bedside.streaming.export import export_stream

SCHEMA = "session bigint, param string, sn bigint, t double, seq bigint, value double, ts timestamp"


@pytest.fixture
def source(spark, tmp_path):
    """Readings written as four files, read as a stream of one file a batch.

    Rows arrive up to 40 seconds late, across files too, and some share an instant.
    """
    rng = random.Random(1)
    rows, t = [], 1_700_000_000.0
    for i in range(200):
        t += rng.choice([3, 3, 3, 8, 60])
        rows.append((1 + i % 2, "HR", i * 500, t, i, rng.choice([60.0, 90.0, 130.0, -1.0, -4.0])))
        if i % 25 == 7:  # a second reading of the instant, and of the next instant nothing
            rows.append((1 + i % 2, "HR", i * 500, t, 1000 + i, 130.0))
    rows.sort(key=lambda r: r[3] + rng.uniform(0, 40))
    for part in range(4):
        df = spark.createDataFrame(
            rows[part * 52 : part * 52 + 52], "session bigint, param string, sn bigint, t double, seq bigint, value double"
        )
        df.withColumn("ts", F.timestamp_seconds("t")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    return spark.read.parquet(str(tmp_path / "in")), stream


def drain(spark, stream, name, tmp_path):
    q = (
        stream.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    )
    q.awaitTermination(120)
    return spark.table(name).collect()


def test_dropouts(spark, source, tmp_path):
    batch, stream = source
    got = {(r.session, r.start, r.stop) for r in drain(spark, dropout_stream(stream, 12.0), "drops", tmp_path)}
    numbered = runs.numbered(runs.marked(batch.drop("ts"), 12.0))
    want = {(r.session, r.start, r.stop) for r in runs.dropouts(numbered, 12.0).collect()}
    # rows of the last minute still wait, and a dropout is closed by the reading after it
    seen = passed(batch)
    times = sorted((r.session, r.t) for r in batch.select("session", "t").distinct().collect())
    after = {s: [t for k, t in times if k == s] for s in (1, 2)}
    assert got == {w for w in want if any(w[2] < t <= seen for t in after[w[0]])}
    assert len(got) > 5


def passed(batch):
    """The watermark at the end of the stream."""
    return batch.agg(F.max("t")).first()[0] - 60.0


def test_silent_series_are_finished(spark, source, tmp_path):
    batch, _ = source
    batch.coalesce(1).write.parquet(str(tmp_path / "more" / "0"))
    late = batch.limit(1).withColumn("session", F.lit(9).cast("bigint")).withColumn("t", F.col("t") + 86400.0)
    late.withColumn("ts", F.timestamp_seconds("t")).write.parquet(str(tmp_path / "more" / "1"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/more/*")
    out = drain(spark, dropout_stream(stream, 12.0), "ended", tmp_path)
    numbered = runs.numbered(runs.marked(batch.drop("ts"), 12.0))
    want = {(r.session, r.start, r.stop) for r in runs.dropouts(numbered, 12.0).collect()}
    assert {(r.session, r.start, r.stop) for r in out} == want
    out = drain(spark, alarm_stream(stream, "HIGH", 100.0), "over", tmp_path)
    limits = al.limit_table(spark, {("HR", "HIGH"): (100, 100)})
    rows = al.threshold_alarms(batch.drop("ts"), limits).collect()
    assert {(r.session, r.start, r.stop, r.xx, r.bucket) for r in out} == {(r.session, r.start, r.stop, r.xx, r.bucket) for r in rows}


def test_alarms(spark, source, tmp_path):
    batch, stream = source
    out = drain(spark, alarm_stream(stream, "HIGH", 100.0), "alarms", tmp_path)
    got = {(r.session, r.start, r.stop, r.xx, r.bucket) for r in out}
    limits = al.limit_table(spark, {("HR", "HIGH"): (100, 100)})
    rows = al.threshold_alarms(batch.drop("ts"), limits).collect()
    want = {(r.session, r.start, r.stop, r.xx, r.bucket) for r in rows}
    assert got == {w for w in want if w[2] <= passed(batch)} and len(got) > 5


def test_export(spark, source, tmp_path):
    batch, stream = source
    got = drain(spark, export_stream(stream, lateness="10 seconds"), "cells", tmp_path)
    from bedside.plans.export import value_text

    want = {
        (r.session, r.w): r.text
        for r in batch.groupBy("session", F.window("ts", "15 seconds").start.alias("w")).agg(value_text(F.col("value")).alias("text")).collect()
    }
    assert len(got) > 20
    assert all(want[(r.session, r.start)] == r.text for r in got)
