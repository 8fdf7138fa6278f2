"""Blocks come back from Python in Arrow batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from bedside.functions import sql
from bedside.sources.tables import planned_blocks


def test_block_rows_return_in_arrow_batches(spark):
    sql.register(spark)
    data = [(f"s{s % 2}", g, 0, 77 * g, 77 * g + n) for s in range(2) for g, n in enumerate([7_200_000_011, 0, 100, 5_400_001])]
    df = spark.createDataFrame(data, "session string, segment bigint, num int, sn0 bigint, sn1 bigint")
    got = spark.sql(
        "SELECT * FROM block_rows(TABLE({d}))", d=df.select("session", "segment", F.col("sn0").alias("min_sn"), F.col("sn1").alias("max_sn"))
    )
    assert "ArrowEvalPythonUDTF" in got._jdf.queryExecution().executedPlan().toString()
    assert got.schema["session"].dataType.simpleString() == "string"
    want = planned_blocks(df).select("session", "segment", "num", "min_sn", "max_sn")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_long_segment_comes_in_strips(spark):
    strip, block = 10_000, 3_600_000  # ticks of two hours
    row = {"session": 1, "segment": 0, "min_sn": 5, "max_sn": 5 + 25_000 * block, "first": strip}
    assert [r[2:4] for r in sql.BlockRows().eval(row)] == [(i, 5 + (strip + i) * block) for i in range(strip)]
    sql.register(spark)
    # numbers go on across strips, segments, equal rows and rows without length
    data = [(1, 0, 5, 5 + 25_000 * block), (1, 1, 0, 9), (1, 2, 7, 7), (1, 2, 9, 7), (1, 3, None, 7), (1, 4, 0, 10_000 * block)]
    data += [(None, 0, 0, 12_000 * block)] * 2 + [(2, 0, 0, 10), (3, 0, -2_000_000_000, 2_000_000_000)]
    df = spark.createDataFrame(data, "session int, segment int, min_sn bigint, max_sn bigint").repartition(3)
    got = {(r.session, r.num): r[1:2] + r[3:] for r in spark.sql("SELECT * FROM block_rows(TABLE({d}))", d=df).collect()}
    assert len(got) == 25_000 + 1 + 10_000 + 24_000 + 1 + 1111
    assert all(got[1, i] == (0, 5 + i * block, 4 + (i + 1) * block) for i in range(25_000))
    assert got[1, 25_000] == (1, 0, 8) and got[2, 0] == (0, 0, 9)
    assert all(got[1, 25_001 + i] == (4, i * block, (i + 1) * block - 1) for i in range(10_000))
    assert all(got[None, 12_000 * k + i] == (0, i * block, (i + 1) * block - 1) for k in range(2) for i in range(12_000))
    small = df.where("session = 3").selectExpr("session", "segment", "CAST(min_sn AS INT) AS min_sn", "CAST(max_sn AS INT) AS max_sn")
    assert spark.sql("SELECT * FROM block_rows(TABLE({d}))", d=small).count() == 1111
