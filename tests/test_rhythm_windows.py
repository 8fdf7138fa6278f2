"""Beat windows and readings in reach follow from scans; entropies of short windows are taken together."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from bedside.operators import features as ft
from bedside.operators import waveform as wf


def test_entropies_of_many_windows_are_those_of_each(monkeypatch):
    rng = np.random.default_rng(4)
    windows = [rng.normal(size=n) for n in (0, 1, 3, 4, 6, 6, 7, 12, 12, 64, 128, 129, 300)]
    windows += [rng.integers(0, 3, 6).astype(float) for _ in range(300)]
    windows += [np.zeros(6), np.array([1.0, np.nan, 2.0, 1.0, 2.0, 1.0]), np.array([1.0, np.inf, 2.0, 1.0, 2.0, 1.0])]
    want = [ft._sample_entropy(w) for w in windows]
    monkeypatch.setattr(ft, "PAIRS", 50)
    assert repr(ft._sample_entropies(windows)) == repr(want)
    assert 20 < sum(not math.isnan(v) for v in want) < len(want)
    # windows of equal length are not measured one by one
    monkeypatch.setattr(ft, "_sample_entropy", None)
    assert len(ft._sample_entropies([np.arange(6.0)] * 5)) == 5


def test_beat_windows_by_hand_without_a_join(either):
    rng = np.random.default_rng(9)
    rows = [(s, float(t), i, float(i % 7)) for s, n, wide in ((1, 40, 300), (2, 25, 40), (3, 1, 9), (4, 3, 2000), (5, 12, 5)) for i, t in enumerate(rng.integers(0, wide, n))]
    beats = either.createDataFrame([*rows, (6, None, 1, 1.0), (None, 3.0, 1, 1.0)], "session bigint, t double, seq bigint, rr double")
    want = {}
    for s in {r[0] for r in rows}:
        own = sorted((t, seq, rr) for k, t, seq, rr in rows if k == s)
        for u in range(math.ceil((own[-1][0] - own[0][0]) / 10)):
            stop = own[0][0] + u * 10.0
            reach = [b for b in own if stop - 35 <= b[0] <= stop][-4:]
            if reach:
                want[s, u] = (stop, [b[0] for b in reach], [b[2] for b in reach])
    windows = wf.beat_windows(beats, 4, 35.0, 10.0)
    if either.conf.get("spark.bedside.sliceRows", "") != "3":
        assert "Join" not in windows._jdf.queryExecution().optimizedPlan().toString()  # before: every beat met every update in its look-back
    assert {(r.session, r["update"]): (r.stop, r.ts, r.rr) for r in windows.collect()} == want and len(want) > 40


def test_readings_in_reach_are_counted_without_a_join(either):
    rng = np.random.default_rng(10)
    spans = [(s, u, float(a), float(a + b)) for s in (1, 2) for u, (a, b) in enumerate(rng.integers(0, 30, (20, 2)))]
    spans += [(3, 0, 1.0, 9.0), (2, 20, None, None)]
    readings = [(s, float(t)) for s in (1, 2, 4) for t in rng.integers(0, 50, 60)]
    w = either.createDataFrame(spans, "session bigint, update bigint, _t0 double, _t1 double")
    hr = either.createDataFrame([*readings, (1, None), (None, 3.0)], "session bigint, t double")
    got = {(r.session, r["update"]): r["_seen"] for r in ft._seen(w, hr, ("session",)).collect()}
    assert got == {(s, u): sum(k == s and a is not None and a <= t <= b for k, t in readings) for s, u, a, b in spans}
    # a row given twice stays twice and each end counts for both, as joining the counts did
    twice = ft._seen(w.where("session = 1 and update = 0").unionAll(w.where("session = 1 and update = 0")).withColumn("x", F.lit(1)), hr, ("session",))
    assert [r["_seen"] for r in twice.collect()] == [2 * got[1, 0]] * 2
