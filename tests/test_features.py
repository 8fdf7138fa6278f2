"""Window features against their plain definitions."""

from __future__ import annotations

import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from bedside.operators import channels as ch
from bedside.operators import features as ft
from bedside.plans import rhythm_model as rhythm
from bedside.operators import waveform as wf


def column(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "i int, a array<double>")


def values(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_sample_entropy_by_pairs(spark):
    rng = np.random.default_rng(2)
    rows = [rng.normal(size=60), np.sin(np.arange(80) / 5), np.arange(10) * 1000.0]
    got = values(column(spark, rows), ft.sample_entropy(F.col("a")))
    for x, e in zip(rows, got):
        r, m = 0.2 * np.std(x), len(x) - 2
        short = long_ = 0
        for i in range(m):
            for j in range(i + 1, m):
                near = max(abs(x[i + k] - x[j + k]) for k in range(2)) < r
                short += near
                long_ += near and abs(x[i + 2] - x[j + 2]) < r
        assert e == pytest.approx(math.log(short / long_)) if long_ else e is None
    assert values(column(spark, [rows[2]]), ft.sample_entropy(F.col("a"), none=-1.0)) == [-1.0]


def test_neighbours_by_all_pairs():
    rng = np.random.default_rng(5)
    shapes = [
        rng.normal(size=(700, 3)), rng.integers(0, 4, (900, 2)) * 0.2, np.zeros((400, 2)), rng.normal(size=(3, 1)),
        np.cumsum(rng.normal(size=(600, 1)), axis=0), np.where(rng.random((500, 3)) < 0.02, np.nan, rng.normal(size=(500, 3))),
        np.empty((0, 2)),
    ]
    for points in shapes:
        near = (np.abs(points[:, None] - points[None]) < 0.2).all(axis=2)
        np.fill_diagonal(near, False)
        assert (ft._neighbours(points, 0.2) == near.sum(axis=1)).all()
        assert not ft._neighbours(points, 0.0).any() and not ft._neighbours(points, math.nan).any()


def test_entropy_of_a_very_long_window_in_bounded_memory():
    """100,000 values; a matrix of their pairs would take 10 GB even as booleans."""
    x = np.random.default_rng(6).integers(0, 2000, 100_000).astype(float)
    tracemalloc.start()
    got = ft._neighbours(x[:, None], 7.0)
    profile = ft._entropy_profile(x, 1, 200.0, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    kinds = np.bincount(x.astype(int), minlength=2000)
    around = np.convolve(kinds, np.ones(13, dtype=int), "same")
    assert (got == around[x.astype(int)] - 1).all()
    wide = np.convolve(kinds, np.ones(399, dtype=int), "same")
    pairs = (wide[x.astype(int)] - 1).sum() / 2
    assert profile[0][1] == pytest.approx(-math.log(pairs / (100_000 * 99_999 / 2)))
    assert peak < 200_000_000


def test_entropy_profile_counts(spark):
    x = np.random.default_rng(4).normal(size=50)
    got = values(column(spark, [x]), ft.entropy_profile(F.col("a"), 2, 0.5))[0]
    n = len(x)
    close = lambda i, j: abs(x[i] - x[j]) < 0.5
    for p in got:
        m = p.length
        a = sum(all(close(i + k, j + k) for k in range(m + 1)) for i in range(n) for j in range(i + 1, n - m))
        b = n * (n - 1) / 2 if m == 0 else sum(
            all(close(i + k, j + k) for k in range(m)) for i in range(n) for j in range(i + 1, n - m)
        )
        assert p.entropy == pytest.approx(-math.log(a / b))
        assert p.error >= math.sqrt(a / b * (1 - a / b) / b)
    assert values(column(spark, [[1, 2, 3]]), ft.entropy_profile(F.col("a"), 2, 0.5)) == [[]]


def test_band_pass_keeps_its_band():
    b, a = ft._band_coefficients(13.0, 16.5, 125.0)
    gain = lambda f: abs(np.polyval(b[::-1], z := np.exp(-2j * np.pi * f / 125)) / np.polyval(a[::-1], z))
    assert gain(13.0) == pytest.approx(math.sqrt(0.5), abs=1e-6)
    assert gain(16.5) == pytest.approx(math.sqrt(0.5), abs=1e-6)
    assert gain(2.0) < 0.1 and gain(40.0) < 0.2
    impulse = np.zeros((1, 200))
    impulse[0, 0] = 1
    h = ft._filtered(impulse, b, a)[0]
    spectrum = abs(np.sum(h * np.exp(-2j * np.pi * 14.6 / 125 * np.arange(200))))
    assert spectrum == pytest.approx(gain(14.6), rel=1e-3)


def test_crossing_share_by_window(spark):
    x = np.sin(np.arange(1024) / 7) * 1000 + 5
    got = values(column(spark, [x]), ft.crossing_share(F.col("a")))[0]
    y = x - x.mean()
    y = y / y.max()
    want = np.mean([100 / 375 * np.sum(np.abs(y[j * 125 : j * 125 + 374]) > 0.2) for j in range(6)])
    assert got == pytest.approx(want)


def test_flat_and_loud_windows_are_gated(spark):
    df = column(spark, [[0.0] * 1024, [3e5, -3e5] * 512, list(np.sin(np.arange(1024) / 7) * 1000)])
    got = [r.f.asDict() for r in df.orderBy("i").select(ft.fibrillation_features(F.col("a")).alias("f")).collect()]
    assert got[0] == {"peak": 0.0, "band_count": -1.0, "crossing": -1.0, "leakage": -1.0, "entropy": -1.0}
    assert got[1]["peak"] == 3e5 and got[1]["crossing"] == -1.0
    assert got[2]["crossing"] > 0 and 0 <= got[2]["leakage"] <= 1


def test_variability_and_kurtosis(spark):
    x = [800.0, 810.0, 790.0, 805.0, 1200.0]
    df = column(spark, [x, [1.0, 1.0]])
    d = np.diff(x)
    assert values(df, ft.variability(F.col("a"))) == [pytest.approx(math.sqrt(sum(d**2) / 3) / np.mean(x)), None]
    c = np.array(x) - np.mean(x)
    assert values(df, ft.kurtosis(F.col("a"))) == [pytest.approx(np.mean(c**4) / np.mean(c**2) ** 2), None]
    assert values(df, ft.turning_points(F.col("a"))) == [2, 0]


def spike_by_hand(v):
    """One window, sample by sample, from the description of the search."""
    m = 16
    top = low = v[m]
    top_at = low_at = None
    bends = []
    for i in range(m + 1, m + 41):
        bends.append((v[i + 1] - v[i]) - (v[i - 1] - v[i - 2]))
        if v[i] >= v[i - 1] and v[i] >= v[i - 6] and v[i] > v[i + 1] and v[i] > v[i + 6] and v[i] > top:
            top, top_at = v[i], i
        if v[i] <= v[i - 1] and v[i] <= v[i - 6] and v[i] < v[i + 1] and v[i] < v[i + 6] and v[i] < low:
            low, low_at = v[i], i
    up, down = top - v[m], v[m] - low
    if up >= down and up > 49:
        sign, peak, height = 1, top_at, up
    elif down > 49:
        sign, peak, height = -1, low_at, down
    else:
        return None
    stop = peak + 24 if max(abs(b) for b in bends) >= 29 else peak
    for j in range(peak + 11, peak + 24):
        w = [sign * v[k] for k in (j - 1, j, j + 1, j + 3)]
        if w[1] < w[0] and w[1] <= w[2] and w[1] <= w[3]:
            stop = j
            break
    return (peak, stop) if sign * (v[peak] - v[stop]) >= 0.5 * height else None


def test_spikes_match_the_search_by_hand():
    rng = np.random.default_rng(8)
    walk = np.cumsum(rng.integers(-20, 21, size=(3000, 143)), axis=1).astype(float)
    bumps = np.zeros((2000, 143))
    for row in bumps:
        at, height = rng.integers(20, 50), rng.integers(-300, 300)
        row += height * np.exp(-((np.arange(143) - at) ** 2) / rng.integers(10, 200)) + rng.normal(size=143)
    v = np.r_[walk, bumps]
    real, peak, stop = wf._measure(v)
    want = [spike_by_hand(row) for row in v]
    assert [(int(p), int(s)) if r else None for r, p, s in zip(real, peak, stop)] == want
    assert 100 < sum(w is not None for w in want) < len(want)


def test_noise_report_of_a_noisy_block(spark):
    n = 60_000
    sn = np.arange(n) * 4
    wave = np.round(20 * np.sin(np.arange(n) / 40))
    marks = np.arange(100, n - 200, 100)
    for m in marks:
        wave[m + 3 : m + 14] += 400 * np.exp(-((np.arange(11) - 5.0) ** 2) / 4)
    filtered = np.zeros(n)
    filtered[marks] = 13
    frame = lambda v: spark.createDataFrame(
        [(1, 0, int(s), float(x)) for s, x in zip(sn, v)], "session bigint, block bigint, sn bigint, value double"
    )
    vitals = {"pr": frame(np.full(n, 70.0)).where("sn % 500 = 0")}
    out = wf.noise_report(frame(filtered), frame(wave), frame(wave), vitals).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.sn_start, r.sn_stop) == (0, int(sn[-1]))
    assert r.ir_med == r.red_med and 15 < r.ir_med < 25
    assert r.ir_nd1 > 90 and r.ir_quant > 300
    assert (r.pr_disp, r.pr_med, r.pr_max) == (100.0, 70.0, 70.0)
    assert wf.noise_report(frame(filtered), frame(wave), frame(wave), vitals, min_marks=10**6).count() == 0


def test_rhythm_codes(spark):
    rows = [
        (1, 0, 100.0, [80.0 + i for i in range(10)], 1, 1),  # fine
        (1, 1, 130.0, [110.0 + i for i in range(10)], 0, 1),  # poor signal
        (1, 2, 160.0, [140.0 + i for i in range(10)], 1, 0),  # leads off
        (1, 3, 190.0, [100.0 + i for i in range(10)], 1, 1),  # stale
        (1, 4, 220.0, [210.0, 211.0], 1, 1),  # too few beats
    ]
    df = spark.createDataFrame(
        [(s, u, t, ts, [800.0, 900.0] * (len(ts) // 2), [0.0] + [100.0] * (len(ts) - 1), [g] * len(ts), [le] * len(ts)) for s, u, t, ts, g, le in rows],
        "session bigint, update bigint, stop double, ts array<double>, rr array<double>, drr array<double>, good array<int>, leads array<int>",
    )
    hr = spark.range(400).select(F.lit(1).cast("bigint").alias("session"), F.col("id").cast("double").alias("t"))
    out = ft.rhythm_updates(df, hr, 4, (0.0, 0.0), (1.0, 1.0), lambda a, b: b > 0).orderBy("update").collect()
    assert [r.code for r in out] == [ft.FIBRILLATION, ft.POOR_SIGNAL, ft.INVALID, ft.INVALID, ft.NO_RHYTHM]
    assert [r.rhythm_start for r in out] == [100.0, 130.0, 160.0, 160.0, 220.0]


def test_channels_merge_on_one_time_axis(either):
    rows = [
        (1, 0, 10, "F", None, 0, 1.0), (1, 0, 12, "F", 5.0, 0, 3.0), (1, 0, 12, "F", 9.0, 1, 99.0),
        (1, 0, 16, "F", None, 0, None), (1, 0, 18, "F", 8.0, 0, 7.0), (1, 0, 20, "F", None, 0, 9.0),
        (1, 0, 12, "S", 5.5, 0, 10.0), (1, 0, 18, "S", None, 0, 40.0), (1, 0, 14, "X", 1.0, 0, 1.0),
        (2, 0, 0, "F", 0.0, 0, 1.0), (2, 0, 6_000_000, "F", 1.0, 0, 1.0),
    ]
    df = either.createDataFrame(rows, "session bigint, block bigint, sn bigint, lead string, t double, seq bigint, value double")
    short = df.where("session = 1")
    got = [tuple(r)[2:] for r in ch.merged_channels(short, ["F", "S"], -1.0, -2.0).orderBy("sn").collect()]
    assert got == [
        (10, 5.5, 1.0, -1.0), (11, 5.5, -1.0, -1.0), (12, 5.5, 3.0, 10.0),
        *[(k, pytest.approx(5.5 + (k - 12) * 2.5 / 6), -2.0 if k == 16 else -1.0, -1.0) for k in range(13, 18)],
        (18, 8.0, 7.0, 40.0), (19, 8.0, -1.0, -1.0), (20, 8.0, 9.0, -1.0),
    ]
    kept = ch.merged_channels(short, ["F", "S"], -1.0, drop_empty=True).orderBy("sn").collect()
    # a sample without a value counts as missing if nothing else is said
    assert [r.sn for r in kept] == [10, 12, 18, 20]
    raised = ch.resampled(short, "F", ["S"]).where("lead = 'S'").orderBy("sn").collect()
    assert [(r.sn, r.t, r.value) for r in raised] == [
        (10, None, None), (12, 5.0, 10.0), (16, None, 30.0), (18, 8.0, 40.0), (20, None, None),
    ]
    optical = ch.merged_optical(short, "F", ["S"]).orderBy("sn").collect()
    assert [r.S for r in optical if r.sn in (10, 11, 16)] == [ch.SATURATED, -(2**31), 30.0]
    # a block beyond three hours of ticks is refused
    assert ch.merged_seismic(df, ["F"]).where("session = 2").count() == 0
    assert [tuple(r) for r in ch.refused_blocks(df).collect()] == [(2, 0, 6_000_000)]
    assert ch.merged_channels(df.where("session = 3"), ["F"]).count() == 0


def test_trained_rhythm_decides_unseen_sessions(spark):
    """Irregular sessions against regular ones: models that never saw a session tell them apart."""
    rng = np.random.default_rng(12)
    rows, marked = [], []
    for session in range(40):
        irregular = session % 2 == 1
        for update in range(8):
            stop = 1000.0 * update + 100.0
            rr = 800 + rng.normal(size=60) * (160 if irregular else 30 + 10 * (session % 3))
            ts = np.linspace(stop - 50, stop - 1, 60)
            rows.append((session, update, stop, ts.tolist(), rr.tolist(), np.diff(rr, prepend=rr[0]).tolist(), [1] * 60, [1] * 60))
        if irregular:
            marked.append((session, 0.0, 1e6))
    # a session with leads off is decided by rule and never trained on
    rows.append((99, 0, 100.0, [90.0] * 60, [800.0] * 60, [0.0] * 60, [1] * 60, [0] * 60))
    df = spark.createDataFrame(
        rows, "session bigint, update bigint, stop double, ts array<double>, rr array<double>, drr array<double>, good array<int>, leads array<int>"
    )
    hr = df.select("session", F.explode(F.sequence(F.lit(0), F.lit(60))).alias("i"), "stop").select("session", (F.col("stop") - F.col("i")).alias("t"))
    features = ft.rhythm_features(df, hr, 60)
    assert [r.fixed for r in features.where("session = 99").collect()] == [ft.INVALID]
    intervals = spark.createDataFrame(marked, "session bigint, begin double, `end` double")
    # windows without an entropy are left out, or one stands for it
    known = features.where("fixed is null and entropy is not null").count()
    assert rhythm.training_rows(features, intervals).count() == known < 320
    trained = rhythm.training_rows(features, intervals, no_entropy=3.0)
    assert trained.count() == 320 and trained.where("label = 1").count() == 160
    scored = rhythm.out_of_fold(trained, folds=4)
    assert scored.groupBy("session").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    figures = rhythm.held_out_figures(scored).first()
    assert figures.windows == 320 and figures.rate == 0.5
    assert figures.accuracy > 0.95 and figures.sensitivity > 0.95 and figures.specificity > 0.95
    model = rhythm.fit(trained)
    codes = ft.rhythm_updates(df, hr, 60, model.centre, model.scale, model, no_entropy=3.0)
    right = codes.join(trained.select("session", "update", "label"), ["session", "update"]).where("code = label").count()
    assert right > 0.95 * 320
    # one label only, and nothing at all
    assert rhythm.fit(trained.where("label = 1")).intercept == math.inf
    assert rhythm.fit(trained.where("label = 2")) is None
    alone = rhythm.out_of_fold(trained.where("session = 1"))
    assert alone.where("probability is null and decided is null").count() == 8
