"""Streams driven by timers give what the batch operators give."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_streaming import SCHEMA, drain, passed, source  # noqa: F401

from bedside.operators import alarms as al
from bedside.operators import runs
from bedside.plans.export import value_text, windowed_export
from bedside.streaming import timed


@pytest.fixture(autouse=True)
def store(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, timed.PROVIDER)
    yield
    spark.conf.set(name, before)


@pytest.fixture
def ended(spark, source, tmp_path):  # noqa: F811
    """The same series, then one row of another a day later: the first are silent by then."""
    batch, _ = source
    for part in range(3):
        batch.where(F.col("seq") % 3 == part).write.parquet(str(tmp_path / "more" / str(part)))
    late = batch.limit(1).withColumn("session", F.lit(9).cast("bigint")).withColumn("t", F.col("t") + 86400.0)
    late.withColumn("ts", F.timestamp_seconds("t")).write.parquet(str(tmp_path / "more" / "9"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 100).parquet(f"{tmp_path}/more/*")
    return batch, stream


def alarm_rows(spark, batch):
    limits = al.limit_table(spark, {("HR", "HIGH"): (100, 100)})
    rows = al.threshold_alarms(batch.drop("ts"), limits).collect()
    return {(r.session, r.start, r.stop, r.xx, r.bucket) for r in rows}


def drops(batch):
    return {(r.session, r.start, r.stop) for r in runs.dropouts(runs.numbered(runs.marked(batch.drop("ts"), 12.0)), 12.0).collect()}


def test_late_rows(spark, source, tmp_path):  # noqa: F811
    batch, stream = source
    out = drain(spark, timed.timed_alarms(stream, "HIGH", 100.0), "timed_alarms", tmp_path)
    got = {(r.session, r.start, r.stop, r.xx, r.bucket) for r in out}
    assert got == {w for w in alarm_rows(spark, batch) if w[2] <= passed(batch)} and len(got) > 5


def test_silent_series(spark, ended, tmp_path):
    batch, stream = ended
    out = drain(spark, timed.timed_alarms(stream, "HIGH", 100.0), "timed_over", tmp_path)
    assert {(r.session, r.start, r.stop, r.xx, r.bucket) for r in out} == alarm_rows(spark, batch)
    out = drain(spark, timed.timed_dropouts(stream, 12.0), "timed_drops", tmp_path)
    assert {(r.session, r.start, r.stop) for r in out} == drops(batch)
    assert len(out) == len(drops(batch)) > 5


def test_export_with_empty_windows(spark, ended, tmp_path):
    batch, stream = ended
    out = drain(spark, timed.timed_export(stream, ["HR", "PR"]), "timed_cells", tmp_path)
    got = sorted((r.session, str(int(r.t + 7.5)), r.hr, r.pr) for r in out)
    want = windowed_export(batch, ["HR", "PR"])
    assert got == sorted((r.session, r.time, r.hr, r.pr) for r in want.collect())
    assert any(r[2] is None for r in got)


def test_window_text(spark):
    cells = [[60.0, 90.0], [60.0, 91.0, -1.0], [-1.0, -4.0], [-4.0, -5.0], [-5.0], [0.0, 1.0, 2.0, 5.0]]
    df = spark.createDataFrame([(i, v) for i, c in enumerate(cells) for v in c], "i int, v double")
    want = {r.i: r.t for r in df.groupBy("i").agg(value_text(F.col("v")).alias("t")).collect()}
    assert [timed.text_of(np.array(c)) for c in cells] == [want[i] for i in range(len(cells))]
    assert timed.text_of(np.array([])) is None
