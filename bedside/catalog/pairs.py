"""As-of joins, the time axis and what is paired by time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import asof, hist
from ..plans import ingest, mining
from . import query
from .base import PRESSURES, READINGS, START, WEEK, continuous, cuff, readings

LOOKBACK = 43200.0

CUFF = PRESSURES + f""", d AS (SELECT session, t, sys, dia, map, pr, error_code, min(seq) AS seq FROM bp GROUP BY ALL),
 dd AS (SELECT *, coalesce(t - lag(t) OVER (PARTITION BY session ORDER BY t, seq), -1) AS delta_t FROM d),
 hits AS (SELECT dd.*, c.t AS ct, c.sys AS csys, c.dia AS cdia, c.map AS cmap, c.seq AS cseq FROM dd
   LEFT JOIN cnibp c ON c.session = dd.session AND c.t >= dd.t - {LOOKBACK} AND c.t < dd.t
   QUALIFY row_number() OVER (PARTITION BY dd.session, dd.seq ORDER BY c.t DESC NULLS LAST, c.seq DESC) = 1)"""


@query(
    "J1_cuff_pairs",
    f"""WITH {CUFF} SELECT session, t, CAST(delta_t AS DOUBLE) AS delta_t, sys, dia, map, coalesce(ct, -1) AS c_t, coalesce(csys, -1) AS c_sys,
    coalesce(cdia, -1) AS c_dia, coalesce(cmap, -1) AS c_map, pr, error_code FROM hits""",
)
def cuff_pairs(spark, sf):
    return asof.cuff_pairs(cuff(spark, sf), continuous(spark, sf), LOOKBACK)


AGREE = PRESSURES + f""", agree AS (SELECT b.session, b.t, b.seq, b.sys, b.dia, b.map, c.t AS c_t, c.sys AS c_sys, c.dia AS c_dia, c.map AS c_map FROM bp b
   JOIN cnibp c ON c.session = b.session AND c.t >= b.t - {LOOKBACK} AND c.t < b.t AND c.map > 0 WHERE b.map > 0
   QUALIFY row_number() OVER (PARTITION BY b.session, b.seq ORDER BY c.t DESC, c.seq DESC) = 1)"""


@query(
    "J2_agreement_pairs",
    f"""WITH {AGREE} SELECT session, t, sys, dia, map, c_t, c_sys, c_dia, c_map, (c_sys + sys) / 2 AS mean_sys, (c_dia + dia) / 2 AS mean_dia,
    (c_map + map) / 2 AS mean_map, c_sys - sys AS diff_sys, c_dia - dia AS diff_dia, c_map - map AS diff_map FROM agree""",
)
def agreement_pairs(spark, sf):
    return asof.agreement_pairs(cuff(spark, sf), continuous(spark, sf), LOOKBACK)


@query(
    "A14_agreement_summary",
    f"""WITH {AGREE} SELECT count(*) AS pairs, {', '.join(f"round(avg(c_{n} - {n}), 6) AS bias_{n}, round(stddev_samp(c_{n} - {n}), 6) AS sd_{n}, round(avg(c_{n} - {n}) - 1.96 * stddev_samp(c_{n} - {n}), 6) AS lower_{n}, round(avg(c_{n} - {n}) + 1.96 * stddev_samp(c_{n} - {n}), 6) AS upper_{n}" for n in ('sys', 'dia', 'map'))}
    FROM agree""",
)
def agreement_summary(spark, sf):
    out = asof.agreement_summary(asof.agreement_pairs(cuff(spark, sf), continuous(spark, sf), LOOKBACK))
    return out.select("pairs", *[F.round(c, 6).alias(c) for c in out.columns if c != "pairs"])


WITHIN = 86400.0


@query(
    "J3_heart_rate_when_needed",
    f"""WITH {READINGS}, hr AS (SELECT * FROM readings WHERE param = 'HR'), pr AS (SELECT * FROM readings WHERE param = 'PR'),
    h AS (SELECT hr.session, hr.seq, hr.t, hr.value, pr.value AS p FROM hr LEFT JOIN pr ON pr.session = hr.session AND pr.t <= hr.t AND pr.t > hr.t - {WITHIN}
      QUALIFY row_number() OVER (PARTITION BY hr.session, hr.seq ORDER BY pr.t DESC NULLS LAST, pr.seq DESC) = 1)
    SELECT session, seq, t, CASE WHEN p IS NULL OR p IN (-1, -2) THEN value ELSE -3 END AS value FROM h""",
)
def heart_rate_when_needed(spark, sf):
    r = readings(spark, sf)
    pr = r.where("param = 'PR'").select("session", "t", "seq", "value")
    hr = r.where("param = 'HR'").select("session", "t", "seq", "value")
    return asof.heart_rate_when_needed(hr, pr, WITHIN)


def _axis(r, param):
    return r.where(F.col("param") == param).select(
        "session", "block", "sn", "seq", F.floor(F.col("value")).cast("double").alias("value")
    )


@query(
    "J4_activity_grid",
    f"""WITH {READINGS}, a AS (SELECT * FROM readings WHERE param = 'PR'), b AS (SELECT * FROM readings WHERE param = 'HR'), p AS (SELECT * FROM readings WHERE param = 'RR'),
    sp AS (SELECT x.session, x.block, greatest(x.lo, y.lo) AS lo, least(x.hi, y.hi) AS hi FROM
      (SELECT session, block, min(sn) AS lo, max(sn) AS hi FROM a GROUP BY ALL) x JOIN
      (SELECT session, block, min(sn) AS lo, max(sn) AS hi FROM b GROUP BY ALL) y ON x.session = y.session AND x.block = y.block),
    g AS (SELECT session, block, unnest(range(lo, hi, 3600)) AS sn FROM sp WHERE lo < hi),
    ga AS (SELECT g.*, floor(a.value) AS arm_value FROM g JOIN a ON a.session = g.session AND a.block = g.block AND a.sn >= g.sn
      QUALIFY row_number() OVER (PARTITION BY g.session, g.block, g.sn ORDER BY a.sn, a.seq) = 1),
    gb AS (SELECT ga.*, floor(b.value) AS wrist_value FROM ga JOIN b ON b.session = ga.session AND b.block = ga.block AND b.sn >= ga.sn
      QUALIFY row_number() OVER (PARTITION BY ga.session, ga.block, ga.sn ORDER BY b.sn, b.seq) = 1)
    SELECT gb.session, gb.block, gb.sn, arm_value, wrist_value, coalesce(floor(p.value), 32768) AS posture_value FROM gb
      LEFT JOIN p ON p.session = gb.session AND p.block = gb.block AND p.sn > gb.sn AND p.sn - gb.sn < 3600
      QUALIFY row_number() OVER (PARTITION BY gb.session, gb.block, gb.sn ORDER BY p.sn, p.seq) = 1""",
)
def activity_grid(spark, sf):
    r = readings(spark, sf)
    return asof.activity_grid({"arm": _axis(r, "PR"), "wrist": _axis(r, "HR")}, _axis(r, "RR"), step=3600)


@query(
    "J5_gain_in_force",
    f"""WITH {READINGS}, s AS (SELECT * FROM readings WHERE param = 'PR'), g AS (SELECT session, block, sn, seq, CAST(seq % 8 AS DOUBLE) AS gain FROM readings WHERE param = 'RR' AND seq % 4 <> 0)
    SELECT s.session, s.block, s.sn, s.seq, coalesce(g.gain, 4) AS gain FROM s ASOF LEFT JOIN g ON s.session = g.session AND s.block = g.block AND s.sn > g.sn""",
)
def gain_in_force(spark, sf):
    r = readings(spark, sf)
    settings = r.where("param = 'RR' and seq % 4 <> 0").select(
        "session", "block", "sn", "seq", (F.col("seq") % 8).cast("double").alias("gain")
    )
    samples = r.where("param = 'PR'").select("session", "block", "sn", "seq")
    return asof.step_value(samples, settings, ["session", "block"], "gain", 4.0)


def _anchors(r):
    # binding: the device clock runs a little fast against the sequence numbers
    return r.where("param = 'TIME_SYNC'").select(
        "session", "block", "seq", "sn", (F.lit(float(START)) + F.col("block") * WEEK + F.floor(F.col("sn") * 33 / 32)).alias("t")
    )


AXIS = READINGS + f""", anchors0 AS (SELECT session, block, seq, sn, CAST({START} + block * {WEEK} + floor(sn * 33 / 32) AS DOUBLE) AS t FROM readings WHERE param = 'TIME_SYNC'),
 ends_ AS (SELECT session, block, arg_min(sn, seq) AS f, arg_max(sn, seq) AS l, max(seq) AS last_seq FROM anchors0 GROUP BY ALL),
 anchors AS (SELECT a.* FROM anchors0 a JOIN ends_ e ON a.session = e.session AND a.block = e.block WHERE a.seq <> e.last_seq OR e.l >= e.f),
 segs AS (SELECT session, block, sn, t, lead(sn) OVER w AS sn1, lead(t) OVER w AS t1 FROM anchors WINDOW w AS (PARTITION BY session, block ORDER BY sn, seq)),
 firsts AS (SELECT session, block, min(sn) AS sn0, arg_min(t, sn) AS t0 FROM anchors GROUP BY ALL)"""


@query(
    "J15_time_axis",
    f"""WITH {AXIS}, r AS (SELECT * FROM readings WHERE param <> 'TIME_SYNC'),
    j AS (SELECT r.session, r.block, r.param, r.seq, r.sn, s.sn AS a, s.t AS ta, s.sn1, s.t1 FROM r
      ASOF LEFT JOIN segs s ON r.session = s.session AND r.block = s.block AND r.sn >= s.sn),
    m AS (SELECT j.*, f.sn0, f.t0, CASE WHEN a IS NOT NULL THEN ta + (j.sn - a) * CASE WHEN sn1 > a THEN (t1 - ta) / (sn1 - a) ELSE 0.002 END
      WHEN f.sn0 IS NOT NULL THEN f.t0 + (j.sn - f.sn0) * 0.002 ELSE j.sn * 2 / 1000.0 END AS t
      FROM j LEFT JOIN firsts f ON f.session = j.session AND f.block = j.block)
    SELECT session, block, param, seq, sn, round(CAST(t AS DOUBLE), 3) AS t FROM m WHERE NOT (a IS NULL AND sn0 IS NOT NULL AND t <= t0 - 300)""",
)
def time_axis(spark, sf):
    r = readings(spark, sf)
    rows = r.where("param <> 'TIME_SYNC'").select("session", "block", "param", "seq", "sn")
    out = asof.with_time(rows, _anchors(r), lead_in=300.0)
    return out.withColumn("t", F.round("t", 3))


@query(
    "J15_sequence_of_time",
    f"""WITH {AXIS}, r AS (SELECT session, block, seq, t FROM readings WHERE param = 'RR'), lastsn AS (SELECT session, block, max(sn) AS sn FROM anchors GROUP BY ALL),
    j AS (SELECT r.session, r.block, r.seq, r.t, s.sn AS a, s.t AS ta, s.sn1, s.t1 FROM r ASOF LEFT JOIN segs s ON r.session = s.session AND r.block = s.block AND r.t >= s.t),
    m AS (SELECT j.*, CASE WHEN a IS NULL THEN f.sn0 WHEN sn1 IS NULL THEN a ELSE a + (j.t - ta) / ((t1 - ta) / (sn1 - a)) END AS x
      FROM j LEFT JOIN firsts f ON f.session = j.session AND f.block = j.block)
    SELECT session, block, seq, CAST(round_even(x, 0) AS BIGINT) AS sn FROM m""",
)
def sequence_of_time(spark, sf):
    r = readings(spark, sf)
    rows = r.where("param = 'RR'").select("session", "block", "seq", "t")
    out = asof.with_sequence(rows, _anchors(r))
    return out.select("session", "block", "seq", "sn")


@query(
    "A23_robust_spread",
    f"""WITH {READINGS}, m AS (SELECT session, median(value) AS median FROM readings GROUP BY session)
    SELECT r.session, round(any_value(m.median), 6) AS median, round(median(abs(value - m.median)), 6) AS mad FROM readings r JOIN m ON m.session = r.session GROUP BY r.session""",
)
def robust_spread(spark, sf):
    out = hist.robust_spread(readings(spark, sf), ["session"], "value")
    return out.select("session", F.round("median", 6).alias("median"), F.round("mad", 6).alias("mad"))


@query(
    "A23_standardised",
    f"""WITH {READINGS} SELECT session, param, seq, CASE WHEN stddev_pop(value) OVER w > 0 THEN round((value - avg(value) OVER w) / stddev_pop(value) OVER w, 6) END AS z FROM readings
    WINDOW w AS (PARTITION BY session, param)""",
)
def standardised(spark, sf):
    out = hist.standardised(readings(spark, sf), ["session", "param"], "value")
    return out.select("session", "param", "seq", F.round("z", 6).alias("z"))


CALIBRATION = PRESSURES + """, cal AS (SELECT session, seq AS cal_id, t AS t_stop, t - (sn - (sn - 3000 - seq % 700 * 500)) / 500.0 AS start FROM bp),
 pos AS (SELECT session, t, seq, floor(value) AS pos1, floor(value / 2) AS pos2 FROM readings WHERE param = 'RR'),
 arm AS (SELECT session, t, seq, floor(value / 3) AS pos1, floor(value / 4) AS pos2 FROM readings WHERE param = 'HR'),
 conn AS (SELECT session, t FROM readings WHERE param = 'PR' AND (seq & 2) = 2),
 sw AS (SELECT session, min(t) AS t FROM readings WHERE param = 'TIME_SYNC' GROUP BY session, block)"""


def _position_sql(name: str, limits) -> str:
    return f"""{name}_p AS (SELECT c.cal_id, p.t, p.seq, p.pos1, p.pos2,
   arg_max(p.pos1, p.t * 1000000000 + p.seq) OVER (PARTITION BY c.cal_id) AS f1, arg_max(p.pos2, p.t * 1000000000 + p.seq) OVER (PARTITION BY c.cal_id) AS f2
   FROM cal c JOIN {name} p ON p.session = c.session AND p.t >= c.start - 86400 AND p.t < c.start WHERE p.pos1 < 16000),
 {name}_c AS (SELECT cal_id, greatest(max(CASE WHEN abs(pos1 - f1) >= {limits[0]} THEN t END), max(CASE WHEN abs(pos2 - f2) >= {limits[1]} THEN t END)) AS at FROM {name}_p GROUP BY cal_id)"""


@query(
    "J6_calibration_times",
    f"""WITH {CALIBRATION}, {_position_sql('pos', (12, 25))}, {_position_sql('arm', (8, 8))},
    e AS (SELECT c.session, c.cal_id, c.start, c.t_stop, greatest(
      coalesce((SELECT max(b.t) FROM bp b WHERE b.session = c.session AND b.t >= c.start - 86400 AND b.t < c.start), 0),
      coalesce((SELECT min(b.t) FROM conn b WHERE b.session = c.session AND b.t >= c.start - 86400 AND b.t < c.start), 0),
      coalesce((SELECT min(b.t) FROM sw b WHERE b.session = c.session AND b.t > c.start - 86400 AND b.t < c.start), 0),
      coalesce(pc.at, 0), coalesce(ac.at, 0)) AS since
      FROM cal c LEFT JOIN pos_c pc ON pc.cal_id = c.cal_id LEFT JOIN arm_c ac ON ac.cal_id = c.cal_id)
    SELECT session, cal_id, CAST(start AS DOUBLE) AS start, CAST(CASE WHEN since > 0 THEN start - since ELSE -1 END AS DOUBLE) AS fill_time,
      CAST(t_stop - start AS DOUBLE) AS inflation_time FROM e""",
)
def calibration_times(spark, sf):
    from ..operators.ranges import calibration_times as times

    r = readings(spark, sf)
    v = F.col("value")

    def position(param, a, b):
        return r.where(F.col("param") == param).select(
            "session", "t", "seq", F.floor(v / a).cast("double").alias("pos1"), F.floor(v / b).cast("double").alias("pos2")
        )

    cal = cuff(spark, sf).select(
        "session", F.col("seq").alias("cal_id"), F.col("t").alias("t_stop"), F.col("sn").alias("stop_sn"),
        (F.col("sn") - 3000 - F.col("seq") % 700 * 500).alias("start_sn"),
    )
    conn = r.where("param = 'PR'").select("session", "t", F.col("seq").cast("int").alias("bits"))
    swaps = r.where("param = 'TIME_SYNC'").groupBy("session", "block").agg(F.min("t").alias("t")).drop("block")
    return times(
        cal, cuff(spark, sf).select("session", "t"), conn, swaps, position("RR", 1, 2), position("HR", 3, 4),
        lookback=86400.0,
    )


@query(
    "C2_packets_to_readings",
    f"""WITH {AXIS}, r AS (SELECT session, block, param, seq, sn, CAST(CASE WHEN param = 'RR' THEN value WHEN floor(value) % 29 = 0 AND value > 0 THEN -(seq % 10 + 1) ELSE value END AS DOUBLE) AS value
      FROM readings WHERE param <> 'TIME_SYNC' AND sn > 0),
    j AS (SELECT r.*, s.sn AS a, s.t AS ta, s.sn1, s.t1 FROM r ASOF LEFT JOIN segs s ON r.session = s.session AND r.block = s.block AND r.sn >= s.sn),
    m AS (SELECT j.*, f.sn0, f.t0, CASE WHEN a IS NOT NULL THEN ta + (j.sn - a) * CASE WHEN sn1 > a THEN (t1 - ta) / (sn1 - a) ELSE 0.002 END
      WHEN f.sn0 IS NOT NULL THEN f.t0 + (j.sn - f.sn0) * 0.002 ELSE j.sn * 2 / 1000.0 END AS t
      FROM j LEFT JOIN firsts f ON f.session = j.session AND f.block = j.block)
    SELECT session, block, param, sn, round(CAST(t AS DOUBLE), 3) AS t, value FROM m WHERE NOT (a IS NULL AND sn0 IS NOT NULL AND t <= t0 - 30)""",
)
def packets_to_readings(spark, sf):
    """Vendor codes are put in first (16384 - code), then ingested back to states."""
    r = readings(spark, sf)
    v = F.col("value")
    coded = F.when(
        (F.col("param") != "RR") & (F.floor(v) % 29 == 0) & (v > 0), 16384 - (F.col("seq") % 10 + 1)
    ).otherwise(v)
    packets = r.where("param <> 'TIME_SYNC'").withColumn("value", coded)
    out = ingest.readings_from_packets(packets, None, _anchors(r))
    return out.select("session", "block", "param", "sn", F.round("t", 3).alias("t"), "value")


@query("C1_calibration_table")
def calibration_table(spark, sf):
    r = readings(spark, sf)
    pos = r.where("param = 'RR'").select("session", "t", "seq", F.col("value").alias("pos1"), F.col("value").alias("pos2"))
    cal = cuff(spark, sf).select(
        "session", F.col("seq").alias("cal_id"), F.col("t").alias("t_stop"), F.col("sn").alias("stop_sn"), (F.col("sn") - 3000).alias("start_sn")
    )
    conn = r.where("param = 'PR'").select("session", "t", F.col("seq").cast("int").alias("bits"))
    sync = r.where("param = 'TIME_SYNC'")
    return mining.calibration_table(cal, cuff(spark, sf).select("session", "t"), conn, sync, pos, pos)
