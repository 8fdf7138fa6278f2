"""Functions called from SQL give what the library functions give."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bedside.functions import codes, device, sql
from bedside.operators.waveform import explode_samples
from bedside.sources.packets import active_alarms
from bedside.sources.tables import planned_blocks


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def known(spark):
    sql.register(spark)
    return spark


def test_scalars(known):
    df = known.createDataFrame([(v, i * 777_777) for i, v in enumerate([16374.0, 16383.0, 16380.5, -1.0, -4.0, -5.0, -9.0, 3.0, None])], "value double, id bigint")
    got = known.sql("SELECT recoded(value), reading_state(value), serial_number(id) FROM {d}", d=df)
    assert rows(got) == rows(df.select(codes.recode(F.col("value")), codes.state(F.col("value")), device.serial_number(F.col("id"))))


def test_samples(known):
    df = known.createDataFrame(
        [(1, 100, [1.0, 2.0, 3.0, 4.0, 5.0], 125), (2, 0, [], 250), (3, 7, None, 250), (4, 9, [None, 1.0], 500)],
        "p int, sn bigint, samples array<double>, sample_rate int",
    )
    got = known.sql("SELECT p, tick, value FROM {d}, LATERAL sample_rows(sn, samples, sample_rate, 1)", d=df)
    assert rows(got) == rows(explode_samples(df).select("p", "sn", "value"))
    got = known.sql(
        """SELECT p, tick, max(value) FILTER (WHERE channel = 0), max(value) FILTER (WHERE channel = 1)
        FROM {d}, LATERAL sample_rows(sn, samples, sample_rate, 2) GROUP BY p, tick""",
        d=df,
    )
    assert rows(got) == rows(explode_samples(df, ["a", "b"]).select("p", "sn", "a", "b"))


def test_alarms(known):
    df = known.createDataFrame(
        [(1, 5, 0.0, [(7, 1, 0, 3), (8, 2, 1, 4)], 0), (1, 6, 1.0, [], 0), (1, 7, 2.0, None, 0)],
        f"session bigint, sn bigint, t double, alarms array<{sql.ALARM}>, status int",
    )
    got = known.sql("SELECT session, sn, t, code, severity, state, start_sn FROM {d}, LATERAL alarm_rows(alarms)", d=df)
    assert rows(got) == rows(active_alarms(df)[0])


def test_blocks(known):
    data = [(s, g, 0, 1000 * g, 1000 * g + n) for s in (1, 2, 3) for g, n in enumerate([7_200_000, 0, 100, 5_400_000, 9_000_001])]
    df = known.createDataFrame([*data, (4, 0, 0, None, 3)], "session bigint, segment int, num int, sn0 bigint, sn1 bigint").repartition(7)
    got = known.sql("SELECT * FROM block_rows(TABLE({d}))", d=df.selectExpr("session", "segment", "sn0 AS min_sn", "sn1 AS max_sn", "'x' AS other"))
    assert rows(got) == rows(planned_blocks(df).select("session", "segment", "num", "min_sn", "max_sn"))
    with pytest.raises(Exception, match="max_sn"):
        known.sql("SELECT * FROM block_rows(TABLE({d}))", d=df.select("session", "segment", F.col("sn0").alias("min_sn")))


def test_functions_of_a_user(known):
    def pairs(name, count):
        return ((name, i) for i in range(count)) if count else None

    sql.register_rows(known, "pairs", pairs, "name string, i int")
    sql.register_feature(known, "spread", lambda w: float(w.max() - w.min()))
    df = known.createDataFrame([("a", 2, [1.0, 4.0]), ("b", 0, None)], "k string, n int, w array<double>")
    assert rows(known.sql("SELECT k, p.i FROM {d}, LATERAL pairs(k, n) p", d=df)) == [("a", 0), ("a", 1)]
    assert rows(known.sql("SELECT k, spread(w) FROM {d}", d=df)) == [("a", 3.0), ("b", None)]
