"""Edge rules on hand-made series."""

from __future__ import annotations

from pyspark.sql import functions as F

from bedside.operators import alarms as al
from bedside.operators import asof, budget, hist, ranges, runs
from bedside.streaming import alarms as st


def series(spark, rows, param="HR"):
    """rows: (sn, t, value)"""
    return spark.createDataFrame(
        [(1, param, sn, float(t), i, float(v)) for i, (sn, t, v) in enumerate(rows)],
        "session bigint, param string, sn bigint, t double, seq bigint, value double",
    )


def numbered(spark, rows, rate=5.0):
    return runs.numbered(runs.marked(series(spark, rows), rate))


def test_adjacent_gaps_merge(either):
    n = numbered(either, [(1, 0, 70), (2, 5, 70), (3, 20, 70), (4, 40, 70), (5, 45, 70), (6, 60, 70)])
    out = runs.dropouts(n, 5.0).orderBy("start").collect()
    assert [(r.start, r.stop) for r in out] == [(10.0, 40.0), (50.0, 60.0)]


def test_gap_at_the_limit_is_none(either):
    n = numbered(either, [(1, 0, 70), (2, 5.1, 70), (3, 10.3, 70)])
    assert [(r.start, r.stop) for r in runs.dropouts(n, 5.0).collect()] == [(10.1, 10.3)]


def test_falling_sequence_starts_an_epoch(either):
    n = numbered(either, [(8, 0, 70), (9, 5, -1), (1, 100, -1), (2, 105, 70)])
    assert runs.dropouts(n, 5.0).count() == 0
    out = runs.state_runs(n, 5.0).orderBy("start").collect()
    # the run of just the last sample of its epoch is dropped
    assert [(r.epoch, r.start, r.stop) for r in out] == [(1, 100.0, 105.0)]


def test_invalid_run_ends_at_last_sample(either):
    n = numbered(either, [(1, 0, 70), (2, 5, -1), (3, 10, -2), (4, 15, -3)])
    out = runs.state_runs(n, 5.0).collect()
    assert [(r.start, r.stop, r.dropout) for r in out] == [(5.0, 15.0, 0.0)]


def test_gap_inside_and_half_inside_a_run(either):
    rows = [(1, 0, -1), (2, 30, -1), (3, 35, 70), (4, 40, -1), (5, 60, 70), (6, 80, 70)]
    out = runs.state_runs(numbered(either, rows), 5.0).orderBy("start").collect()
    # the second run's gap goes on past its end, so it is not wholly inside
    assert [(r.start, r.stop, r.dropout) for r in out] == [(0.0, 35.0, 25.0), (40.0, 60.0, 0.0)]


def test_budget_adds_up(either):
    rows = [(1, 0, 70), (2, 5, -1), (3, 30, 70), (1, 40, -2), (2, 45, 70), (3, 100, 70)]
    r = budget.parameter_times(series(either, rows), 5.0).collect()[0]
    assert (r.active, r.xx, r.dropout, r.on_network) == (90.0, 30.0, 70.0, 20.0)
    assert r.on_network + r.dropout == r.active


def test_single_reading_has_no_share(either):
    r = budget.parameter_times(series(either, [(1, 0, 70)]), 5.0).collect()[0]
    assert (r.active, r.on_network_pct, r.display_pct) == (0.0, -1.0, -1.0)


def test_duration_bins_are_half_open(spark):
    df = spark.createDataFrame([(1, float(x)) for x in (0, 29, 30, 7199, 7200, 10**6, -1)], "k int, d double")
    out = hist.duration_histogram(df, ["k"], F.col("d")).orderBy("bin").collect()
    assert [(r.bin, r.frequency) for r in out] == [(30, 2), (60, 1), (7200, 1), (7201, 2)]


def test_last_fixed_bin_is_closed(spark):
    df = spark.createDataFrame([(1, float(x)) for x in (-1, 8, 9, 1999, 2000)], "k int, v double")
    out = {r.bin: r.frequency for r in hist.fixed_width_histogram(df, ["k"], F.col("v")).collect()}
    assert len(out) == 200 and out[-1] == 2 and out[9] == 1 and out[1989] == 1 and sum(out.values()) == 4


def alarms(spark, rows, kind="HIGH", limit=100):
    limits = al.limit_table(spark, {("HR", kind): (limit, limit)})
    out = al.threshold_alarms(series(spark, rows), limits).orderBy("start").collect()
    return [(r.start, r.stop, r.xx, r.bucket) for r in out]


def test_invalid_between_alarms_is_bridged(either):
    rows = [(1, 0, 120), (2, 10, -1), (3, 20, 120), (4, 30, 80)]
    assert alarms(either, rows) == [(0.0, 30.0, 10.0, 20.0)]


def test_invalid_before_normal_ends_the_alarm(either):
    rows = [(1, 0, 80), (2, 10, 120), (3, 20, -2), (4, 35, 80)]
    assert alarms(either, rows) == [(10.0, 35.0, 15.0, 10.0)]


def test_invalid_before_an_alarm_is_not_counted(either):
    rows = [(1, 0, 80), (2, 10, -3), (3, 20, 120), (4, 30, 80)]
    assert alarms(either, rows) == [(20.0, 30.0, 0.0, 10.0)]


def test_limits_and_codes(either):
    rows = [(1, 0, 100), (2, 10, -5), (3, 20, -4), (4, 30, -6), (5, 40, 99)]
    assert alarms(either, rows) == [(0.0, 10.0, 0.0, 10.0), (20.0, 40.0, 0.0, 20.0)]
    assert alarms(either, rows, "LOW", 100)[0][:2] == (0.0, 40.0)


def test_bucket_leaks(either):
    rows = [(1, 0, 120), (2, 90, 80), (3, 91, 120), (4, 100, 80), (5, 200, 120), (6, 210, 80)]
    assert alarms(either, rows) == [(0.0, 90.0, 0.0, 90.0), (91.0, 100.0, 0.0, 69.0), (200.0, 210.0, 0.0, 10.0)]


def test_run_on_the_last_sample_is_an_alarm_of_no_length(either):
    assert alarms(either, [(1, 0, 80), (2, 10, 120)]) == [(10.0, 10.0, 0.0, 0.0)]


def test_alarms_match_a_plain_fold(either):
    import random

    rng = random.Random(5)
    values = [20.0, 60.0, 90.0, 110.0, 140.0, -1.0, -2.0, -4.0, -5.0, -6.0]
    rows, t = [], 0.0
    for i in range(400):
        t += rng.choice([1, 2, 5, 60, 400])
        rows.append((i, t, rng.choice(values)))
    for kind, limits in (("HIGH", (60, 100, 120)), ("LOW", (20, 60, 100))):
        for limit in limits:
            state, found = st.fold(st.FRESH, [(t, st.reading_class(kind, v, limit)) for _, t, v in rows])
            found += st.finish(state, rows[-1][1])
            assert alarms(either, rows, kind, limit) == found


def test_sweep_counts_every_delay(spark):
    rows = spark.createDataFrame(
        [(1, "HR", "HIGH", 100, 0.0, 12.0, 0.0, 12.0), (1, "HR", "HIGH", 100, 20.0, 27.0, 0.0, 7.0)],
        "session bigint, param string, kind string, limit bigint, start double, stop double, xx double, bucket double",
    )
    out = al.delay_sweep(rows).orderBy("delay").collect()
    assert [(r.delay, r.alarms, r.time_over_threshold) for r in out] == [(0, 2, 19), (5, 2, 19), (10, 1, 12)]


def test_asof_bounds(either):
    left = either.createDataFrame([(1, 300.0, 1), (1, 1000.0, 2)], "session bigint, t double, seq bigint")
    right = either.createDataFrame(
        [(1, 0.0, 1, "a"), (1, 300.0, 2, "b"), (1, 699.0, 3, "c")], "session bigint, t double, seq bigint, v string"
    )
    # exactly at t - 300 matches, exactly at t does not, 301 before does not
    out = asof.last_before(left, right, ["session"], ["v"], 300.0).orderBy("t").collect()
    assert [r.match.v if r.match else None for r in out] == ["a", None]
    out = asof.last_before(left, right, ["session"], ["v"], 300.0, inclusive=True).orderBy("t").collect()
    assert [r.match.v if r.match else None for r in out] == ["b", None]


def test_time_axis_without_sync(either):
    rows = either.createDataFrame([(1, 0, 500, 1)], "session bigint, block bigint, sn bigint, seq bigint")
    none = either.createDataFrame([], "session bigint, block bigint, seq bigint, sn bigint, t double")
    assert asof.with_time(rows, none).collect()[0].t == 1.0


def test_sync_after_a_reset_is_left_out(either):
    anchors = either.createDataFrame(
        [(1, 0, 1, 1000, 100.0), (1, 0, 2, 2000, 104.0), (1, 0, 3, 10, 900.0)],
        "session bigint, block bigint, seq bigint, sn bigint, t double",
    )
    rows = either.createDataFrame(
        [(1, 0, 1500, 1), (1, 0, 2500, 2), (1, 0, 500, 3)], "session bigint, block bigint, sn bigint, seq bigint"
    )
    out = {r.sn: r.t for r in asof.with_time(rows, anchors).collect()}
    assert out == {1500: 102.0, 2500: 105.0, 500: 99.0}


def test_touching_intervals_stay_apart(either):
    df = either.createDataFrame([(1, 0, 5), (1, 5, 9), (1, 8, 12), (1, 1, 2)], 'session bigint, begin bigint, end bigint')
    out = runs.merge_intervals(df, ["session"], "begin", "end").orderBy("begin").collect()
    assert [(r.begin, r.end, r.merged) for r in out] == [(0, 5, 2), (5, 12, 2)]


def test_delays_match_a_plain_fold(either):
    import random

    rng = random.Random(3)
    rows, t = [], 0
    for _ in range(80):
        t += rng.randint(1, 12)
        end = t + rng.randint(1, 9)
        rows.append((1, t, end))
        t = end
    want = []
    for _, b, e in rows:
        if want and b < want[-1][1]:
            want[-1][1] = max(want[-1][1], e + 6)
        elif e - b > 5:
            want.append([b + 5, e + 6])
    df = either.createDataFrame(rows, "session bigint, begin bigint, end bigint")
    out = runs.apply_delays(df, 5, 6).orderBy("begin").collect()
    assert [[r.begin, r.end] for r in out] == want


def test_overlap_pairs_once(spark):
    a = spark.createDataFrame([(1, 0, 100), (1, 50, 60)], "k int, x bigint, y bigint")
    b = spark.createDataFrame([(1, 5, 95), (1, 100, 110), (2, 0, 9)], "k int, x bigint, y bigint")
    span = (F.col("x"), F.col("y"))
    out = ranges.overlap_join(a, b, ["k"], span, span, 10.0).collect()
    assert sorted((r.a.x, r.b.x) for r in out) == [(0, 5), (0, 100), (50, 5)]


def test_census_hour_edges(spark):
    s = spark.sql(
        """select 1 site_id, null as care_unit, 7 device_id, timestamp'2024-01-02 01:00:00' start, timestamp'2024-01-02 03:00:00' stop
        union all select 1, null, 7, timestamp'2024-01-02 01:00:00', timestamp'2024-01-02 03:00:00'
        union all select 1, null, 8, timestamp'2024-01-02 02:59:00', timestamp'2024-01-02 03:29:00'"""
    ).withColumn("care_unit", F.col("care_unit").cast("string"))
    out = ranges.hourly_census(s, s.select("site_id", "care_unit").distinct(), "2024-01-02", "2024-01-04")
    rows = {(str(r.date), r.hour): r.devices for r in out.collect()}
    assert len(rows) == 48
    # ends at three, so hour three is empty; the half-hour session is not longer than 30 minutes
    assert [rows[("2024-01-02", h)] for h in (0, 1, 2, 3)] == [0, 1, 1, 0]


def test_missing_care_unit_is_a_unit(spark):
    from bedside.plans import site_health as health

    s = spark.createDataFrame(
        [("A", None, "2024-01-01", 3600), ("A", "ICU", "2024-01-01", 7200), ("A", None, "2024-01-01", 3599)],
        "site string, care_unit string, d string, duration bigint",
    ).withColumn("date_stop", F.col("d").cast("date"))
    out = {r.care_unit: (r.sessions, r.hours) for r in health.site_hours(s, "2024-01-01", "2024-01-31").collect()}
    assert out == {None: (1, 1.0), "ICU": (1, 2.0)}


def test_empty_input_gives_empty_results(spark):
    empty = series(spark, [])
    assert budget.parameter_times(empty, 5.0).count() == 0
    assert al.threshold_alarms(empty, al.limit_table(spark)).count() == 0


def test_every_heart_rate_is_swept(spark):
    ranges = {(r.param, r.kind): (r.first, r.last) for r in al.limit_table(spark).collect()}
    for kind in ("HIGH", "LOW"):
        assert ranges["HR_A", kind] == ranges["HR", kind]
    rows = [(1, "HR_A", i, i * 5.0, i, 200.0 if 2 <= i < 6 else 60.0) for i in range(10)]
    df = spark.createDataFrame(rows, "session bigint, param string, sn bigint, t double, seq bigint, value double")
    assert al.threshold_alarms(df, al.limit_table(spark)).where("param = 'HR_A'").count() > 0
