"""Missing ticks are made from rows in order; nothing joins or sorts them."""

from __future__ import annotations

from bedside.operators import channels as ch


def test_ticks_between_rows_take_no_join(spark, monkeypatch):
    monkeypatch.setattr(ch, "STRIP", 4)
    rows = [(1, 0, 10, "F", 0, 1.0, 5.0), (1, 0, 30, "F", 1, None, 6.0), (1, 0, 31, "F", 2, 3.0, None), (1, 0, 31, "F", 3, 9.0, 9.0), (2, 0, 7, "F", 0, None, 1.0)]
    s = spark.createDataFrame(rows, "session int, block int, sn bigint, lead string, seq int, t double, value double")
    out = ch.merged_channels(s, ["F"], -1.0, -2.0, max_ticks=None)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r.sn: (r.t, r.F) for r in out.where("session = 1").collect()}
    assert sorted(got) == list(range(10, 32))
    assert got[10] == (1.0, 5.0) and got[31] == (3.0, -2.0) and got[30][1] == 6.0
    assert all(abs(got[sn][0] - (1.0 + (sn - 10) * 2.0 / 21)) < 1e-12 for sn in range(10, 32))
    assert all(got[sn][1] == -1.0 for sn in range(11, 30))
    assert [tuple(r) for r in out.where("session = 2").collect()] == [(2, 0, 7, None, 1.0)]
    assert ch.merged_channels(s, ["F"], max_ticks=20).select("session").distinct().collect() == [(2,)]
