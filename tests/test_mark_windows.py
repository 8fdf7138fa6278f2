"""Windows around marks: samples are shuffled once and no window goes through a shuffle."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from bedside.operators import waveform as wf

COLUMNS = "session bigint, block bigint, sn bigint, value double"


def _plain(samples, marks, counted=None):
    """Each block by itself: windows of 143 samples around all marks but the first and the last two."""
    out = {}
    for key in {r[:2] for r in samples}:
        line = sorted(r[2:] for r in samples if r[:2] == key)
        hit = [i for i, (sn, _) in enumerate(line) if (*key, sn) in marks]
        for rank, i in enumerate(hit, 1):
            if 1 < rank <= (len(hit) if counted is None else counted[key]) - 2 and i >= 15 and i + 127 < len(line):
                part = line[i - 15 : i + 128]
                out[(*key, line[i][0])] = ([p[0] for p in part], [p[1] for p in part])
    return out


def test_windows_by_hand_without_a_join(either):
    rng = np.random.default_rng(3)
    sizes = {(1, 0): 700, (1, 1): 143, (2, 0): 150, (2, 1): 128, (3, 0): 1, (4, 7): 400}
    samples = [(*k, int(sn), float(v)) for k, n in sizes.items() for sn, v in zip(np.cumsum(rng.integers(1, 5, n)), rng.normal(size=n))]
    marks = {r[:3] for r in samples if rng.random() < 0.1} | {(1, 0, 10**6), (9, 9, 1)}
    s = either.createDataFrame(samples, COLUMNS)
    # a mark may come twice, and one without a key marks nothing
    m = either.createDataFrame([*marks, *list(marks)[:20], (None, 0, 5)], "session bigint, block bigint, sn bigint")
    windows = wf.mark_windows(s, m)
    assert "Join" not in windows._jdf.queryExecution().optimizedPlan().toString()  # before: joins by mark and by 128 positions
    got = {(r.session, r.block, r.mark_sn): (r.sns, r.ppg) for r in windows.collect()}
    assert got == _plain(samples, marks) and len(got) > 50
    counts = either.createDataFrame([(1, 0, 20), (4, 7, 99)], "session bigint, block bigint, _marks bigint")
    got = {(r.session, r.block, r.mark_sn): (r.sns, r.ppg) for r in wf.mark_windows(s, m, counts=counts).collect()}
    assert got == _plain([r for r in samples if r[:2] in {(1, 0), (4, 7)}], marks, {(1, 0): 20, (4, 7): 99})


def test_marks_of_a_report_are_those_of_the_light_that_has_most(spark):
    n = 400
    light = [(1, 0, i, float((i * 37) % 11)) for i in range(n)]
    red = [r for r in light if r[2] < 200] + [(2, 0, i, 0.0) for i in range(n)]
    filtered = [(k, 0, i, 13.0 if i % 20 == 0 else 0.0) for k in (1, 2) for i in range(n)]
    frame = lambda rows: spark.createDataFrame(rows, COLUMNS)
    report = lambda least: wf.noise_report(frame(filtered), frame(light), frame(red), {}, min_marks=least).collect()
    # session 2 has no infrared light
    assert [(r.session, r.sn_start, r.sn_stop, r.ir_quant) for r in report(18)] == [(1, 0, n - 1, 0.0)]
    assert report(19) == []


def test_a_spike_search_looks_at_each_window_once(spark):
    w = spark.range(3).select(F.lit(1).alias("session"), F.lit(0).alias("block"), F.array_repeat(F.col("id"), 143).alias("sns"), F.array_repeat(F.lit(0.0), 143).alias("ppg"))
    plan = wf.noise_spikes(w)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
