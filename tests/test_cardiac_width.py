"""Time buckets of the cardiac sweep follow the length of alarms and runs."""

from __future__ import annotations

from bedside.operators import cardiac


def test_long_alarms_are_not_repeated_for_every_hour(spark, monkeypatch):
    day = 86_400.0
    alarms = [
        (s, p, "HIGH", 100 + s, (3 * i + k) * day, (3 * i + k + 1 + s) * day, 200.0 * i)
        for s in (0, 1) for k, p in enumerate(("PR", "HR")) for i in range(6)
    ]
    runs = [(s, (4 * i + 1) * day, (4 * i + 3) * day) for s in (0, 1) for i in range(5)]
    a = spark.createDataFrame(alarms, "session bigint, param string, kind string, limit bigint, start double, stop double, bucket double")
    x = spark.createDataFrame(runs, "session bigint, start double, stop double")
    widths = []

    def seen(*args, **kw):
        widths.append(args[5])
        return join(*args, **kw)

    join = cardiac.overlap_join
    monkeypatch.setattr(cardiac, "overlap_join", seen)
    own = sorted(map(str, cardiac.cardiac_sweep(a, x).collect()))
    hourly = sorted(map(str, cardiac.cardiac_sweep(a, x, width=3600.0).collect()))
    assert own and own == hourly
    assert widths == [2 * day, 3600.0]
    assert cardiac.cardiac_sweep(a.limit(0), x.limit(0)).count() == 0
