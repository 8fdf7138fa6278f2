"""Blocks of segments: pairs with chunks without making every block."""

from __future__ import annotations

from pyspark.sql import functions as F

from bedside.operators import ranges
from bedside.sources import tables

COLUMNS = "session bigint, segment bigint, num bigint, sn0 bigint, sn1 bigint"


def test_chunks_meet_the_blocks_of_their_segment(spark):
    lengths = [3_600_000, 7_200_000, 5_400_000, 9_000_001, 40_000_003, 100, 0]
    rows = []
    for s, length in enumerate(lengths):
        lo = 1_000 * s
        rows += [(s % 3, s, 0, lo, lo + length // 3), (s % 3, s, 1, lo + length // 2, lo + length - 1), (s % 3, s, 2, lo + length, lo + length)]
        # before the first, across all, behind the last, upside down
        rows += [(s % 3, s, 1, lo - 9, lo - 1), (s % 3, s, 1, lo - 9, lo + 2 * length), (s % 3, s, 1, lo + length + 1, lo + 2 * length), (s % 3, s, 1, lo + length, lo)]
    chunks = spark.createDataFrame(rows, COLUMNS)
    want = ranges.chunks_of_blocks(chunks.where("sn0 <= sn1"), tables.planned_blocks(chunks))
    got = tables.chunks_of_planned_blocks(chunks).select(want.columns)
    assert {tuple(r) for r in want.collect()} <= {tuple(r) for r in got.collect()}
    blocks, plain = tables.planned_blocks(chunks).collect(), chunks.collect()
    pairs = [
        (b.session, b.segment, b.num, c.num, b.min_sn, b.max_sn)
        for b in blocks for c in plain
        if (b.session, b.segment) == (c.session, c.segment) and c.sn0 <= b.max_sn and b.min_sn <= c.sn1
    ]
    assert sorted(tuple(r) for r in got.collect()) == sorted(pairs)


def test_blocks_that_no_chunk_meets_are_not_made(spark):
    far = 10**16
    chunks = spark.createDataFrame([(1, 0, 0, 0, 10), (1, 0, 1, far - 10, far)], COLUMNS)
    got = tables.chunks_of_planned_blocks(chunks).orderBy("block").collect()
    assert [r.chunk for r in got] == [0, 1] and got[0].block == 0 and got[1].block > 2**31


def test_overlap_join_builds_no_side_on_the_driver(spark):
    a = spark.range(10).select("id", (F.col("id") * 2).alias("lo"), (F.col("id") * 2 + 3).alias("hi"))
    span = (F.col("lo"), F.col("hi"))
    plan = ranges.overlap_join(a, a, ["id"], span, span, 5.0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_blocks_are_made_in_strips_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(tables, "STRIP", 7)
    monkeypatch.setattr(tables, "TASK_BLOCKS", 100)
    hour = 3_600_000  # two hours of ticks
    chunks = spark.createDataFrame([(1, 0, 0, 5, 1500 * hour + 4), (1, 1, 0, 0, 20 * hour), (2, 0, 0, 0, 10), (3, 0, 0, 7, 7)], COLUMNS)
    out = tables.planned_blocks(chunks)
    assert out.rdd.getNumPartitions() == 16  # 1,521 blocks; before, one segment was one task
    got = {(r.session, r.num): (r.segment, r.min_sn, r.max_sn) for r in out.collect()}
    assert len(got) == out.count() == 1521
    for i in range(1500):
        assert got[1, i] == (0, 5 + i * hour, min(5 + (i + 1) * hour - 1, 1500 * hour + 4))
    assert [got[1, 1500 + i][0] for i in range(20)] == [1] * 20 and got[1, 1519] == (1, 19 * hour, 20 * hour - 1)
    assert got[2, 0] == (0, 0, 9)
