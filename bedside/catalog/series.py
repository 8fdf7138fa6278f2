"""Windows, budgets, histograms and alarms over the readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes
from ..operators import alarms as al
from ..operators import cardiac
from ..operators import budget, hist, runs
from ..operators.slices import balance
from ..plans import export, mining
from ..model import DURATION_EDGES, LAST_BIN_LABEL
from ..session import literal_table
from . import query
from .base import (
    ALARMS,
    DROPOUTS,
    MARKS,
    PRESSURES,
    RATE,
    READINGS,
    continuous,
    cuff,
    device_alarms,
    readings,
)

BIN = "CASE " + " ".join(
    f"WHEN {{d}} >= {low} THEN {label}"
    for low, label in reversed(list(zip(DURATION_EDGES, [*DURATION_EDGES[1:], LAST_BIN_LABEL])))
) + " END"


def _numbered(spark, sf):
    return runs.numbered(runs.marked(readings(spark, sf), RATE))


@query(
    "W1_reset_epochs",
    f"""WITH {READINGS} SELECT session, param, CAST(epoch AS BIGINT) AS epoch, count(*) AS n, min(t) AS first_t, max(t) AS last_t
    FROM (SELECT *, sum(CASE WHEN fell THEN 1 ELSE 0 END) OVER (PARTITION BY session, param ORDER BY t, seq ROWS UNBOUNDED PRECEDING) AS epoch
      FROM (SELECT *, coalesce(sn < lag(sn) OVER (PARTITION BY session, param ORDER BY t, seq), false) AS fell FROM readings))
    GROUP BY session, param, epoch""",
)
def reset_epochs(spark, sf):
    return (
        runs.epochs(readings(spark, sf))
        .groupBy("session", "param", "epoch")
        .agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))
    )


@query(
    "W2_dropouts",
    f"WITH {DROPOUTS} SELECT session, param, CAST(epoch AS BIGINT) AS epoch, start, stop FROM dropouts",
)
def dropouts(spark, sf):
    return runs.dropouts(_numbered(spark, sf), RATE).drop("inside_run")


@query(
    "W3_state_runs",
    f"WITH {DROPOUTS} SELECT session, param, CAST(epoch AS BIGINT) AS epoch, start, stop, CAST(dropout AS DOUBLE) AS dropout FROM runs",
)
def state_runs(spark, sf):
    return runs.state_runs(_numbered(spark, sf), RATE).drop("run_id")


TIMES = (
    MARKS
    + f""", times AS (
  SELECT *, CASE WHEN active > 0 THEN 100.0 * on_network / active ELSE -1 END AS on_network_pct,
    CASE WHEN on_network > 0 THEN 100.0 * (on_network - xx) / on_network ELSE -1 END AS display_pct
  FROM (SELECT *, active - dropout AS on_network FROM (
    SELECT session, param, sum(coalesce(next_t - t, 0.0)) AS active,
      sum(CASE WHEN flagged THEN coalesce(next_t - t, 0.0) ELSE 0.0 END) AS xx,
      sum(CASE WHEN gap THEN next_t - t - CASE WHEN prev_gap THEN 0 ELSE {RATE} END ELSE 0.0 END) AS dropout
    FROM numbered GROUP BY session, param)))"""
)


@query(
    "A1_parameter_times",
    f"""WITH {TIMES} SELECT session, param, active, xx, dropout, on_network, CAST(on_network_pct AS DOUBLE) AS on_network_pct,
    CAST(display_pct AS DOUBLE) AS display_pct FROM times""",
)
def parameter_times(spark, sf):
    return budget.parameter_times(readings(spark, sf), RATE)


@query(
    "A2_oximeter_times",
    f"""WITH {READINGS}, s AS (
      SELECT *, lag(t) OVER w AS pt, lag(sn) OVER w AS psn, lead(t) OVER w AS nt, lead(sn) OVER w AS nsn
      FROM readings WHERE param = 'SPO2' WINDOW w AS (PARTITION BY session ORDER BY t, seq)),
    m AS (SELECT session, CASE WHEN nsn >= sn THEN nt - t ELSE 0 END AS span, value,
      coalesce(nsn >= sn AND nt - t > {RATE} + 0.1, false) AS gap,
      coalesce(sn >= psn AND t - pt > {RATE} + 0.1, false) AS prev_gap FROM s),
    g AS (SELECT session, 'SPO2' AS param, sum(span) AS active,
      sum(CASE WHEN (value < 0 AND value > -4) OR value = -10 THEN span ELSE 0.0 END) AS xx,
      sum(CASE WHEN value = -10 THEN span ELSE 0.0 END) AS xx_sensor_off,
      sum(CASE WHEN gap THEN span - CASE WHEN prev_gap THEN 0 ELSE {RATE} END ELSE 0.0 END) AS dropout FROM m GROUP BY session),
    h AS (SELECT *, xx - xx_sensor_off AS xx_sensor_on, active - dropout AS on_network FROM g)
    SELECT *, CAST(CASE WHEN active > 0 THEN 100.0 * on_network / active ELSE -1 END AS DOUBLE) AS on_network_pct,
      CAST(CASE WHEN on_network > 0 THEN 100.0 * (on_network - xx) / on_network ELSE -1 END AS DOUBLE) AS display_pct,
      CAST(CASE WHEN on_network > 0 THEN 100.0 * (on_network - xx_sensor_on) / on_network ELSE -1 END AS DOUBLE) AS display_sensor_on_pct,
      CAST(CASE WHEN on_network > 0 THEN 100.0 * xx_sensor_off / on_network ELSE -1 END AS DOUBLE) AS sensor_off_pct FROM h""",
)
def oximeter_times(spark, sf):
    return budget.oximeter_times(readings(spark, sf).where("param = 'SPO2'"), RATE)


SESSION_TIMES = TIMES + """, session_times AS (
  SELECT *, greatest(wrist_on_network, cable_on_network) AS session_on_network,
    greatest(wrist_active, cable_active) AS session_active FROM (
    SELECT session,
      coalesce(max(CASE WHEN param IN ('TIME_SYNC', 'PR', 'SPO2') THEN on_network END), -1) AS wrist_on_network,
      coalesce(max(CASE WHEN param IN ('TIME_SYNC', 'PR', 'SPO2') THEN active END), -1) AS wrist_active,
      coalesce(max(CASE WHEN param IN ('TEMP', 'HR', 'RR') THEN on_network END), -1) AS cable_on_network,
      coalesce(max(CASE WHEN param IN ('TEMP', 'HR', 'RR') THEN active END), -1) AS cable_active
    FROM times GROUP BY session))"""


@query(
    "A3_session_times",
    f"""WITH {SESSION_TIMES} SELECT session, CAST(wrist_on_network AS DOUBLE) AS wrist_on_network, CAST(wrist_active AS DOUBLE) AS wrist_active,
    CAST(cable_on_network AS DOUBLE) AS cable_on_network, CAST(cable_active AS DOUBLE) AS cable_active,
    CAST(session_on_network AS DOUBLE) AS session_on_network, CAST(session_active AS DOUBLE) AS session_active FROM session_times""",
)
def session_times(spark, sf):
    return budget.session_times(budget.parameter_times(readings(spark, sf), RATE))


@query(
    "A4_invalid_histogram",
    f"""WITH {DROPOUTS} SELECT session, param, CAST({BIN.format(d='(stop - start)')} AS BIGINT) AS bin, count(*) AS frequency,
    CAST(trunc(sum(stop - start)) AS BIGINT) AS seconds, CAST(trunc(sum(dropout)) AS BIGINT) AS dropout_seconds
    FROM runs WHERE stop - start >= 0 GROUP BY ALL""",
)
def invalid_histogram(spark, sf):
    rows = runs.state_runs(_numbered(spark, sf), RATE)
    span = F.col("stop") - F.col("start")
    return hist.duration_histogram(rows, ["session", "param"], span, dropout_seconds=F.col("dropout"))


@query(
    "A4_dropout_histogram",
    f"""WITH {DROPOUTS} SELECT param, CAST({BIN.format(d='(stop - start)')} AS BIGINT) AS bin, count(*) AS frequency,
    CAST(trunc(sum(stop - start)) AS BIGINT) AS seconds FROM dropouts WHERE stop - start >= 0 GROUP BY ALL""",
)
def dropout_histogram(spark, sf):
    rows = runs.dropouts(_numbered(spark, sf), RATE)
    return hist.duration_histogram(rows, ["param"], F.col("stop") - F.col("start"))


RANGES = [("PR", 0, 240), ("HR", 0, 240), ("SPO2", 49, 100), ("RR", 0, 50)]


@query(
    "A5_value_histogram",
    f"""WITH {READINGS} SELECT session, param, CAST(floor(value) AS BIGINT) AS bin, count(*) AS frequency FROM readings
    JOIN (VALUES ('PR', 0, 240), ('HR', 0, 240), ('SPO2', 49, 100), ('RR', 0, 50)) v(p, low, high) ON param = p
    WHERE value > -1 AND floor(value) BETWEEN low AND high GROUP BY ALL""",
)
def value_histogram(spark, sf):
    table = literal_table(spark, RANGES, "param string, low int, high int")
    return hist.value_histogram(readings(spark, sf), table)


@query(
    "A6_code_histogram",
    f"WITH {ALARMS} SELECT session, code, count(*) AS frequency FROM alarms GROUP BY ALL",
)
def code_histogram(spark, sf):
    return hist.code_histogram(device_alarms(spark, sf), ["session"], F.col("code"))


@query(
    "A7_alarm_histogram",
    f"WITH {ALARMS} SELECT session, code, count(DISTINCT start_sn) AS alarms FROM alarms GROUP BY ALL",
)
def alarm_histogram(spark, sf):
    return hist.alarm_histogram(device_alarms(spark, sf))


@query(
    "A8_fixed_width_histogram",
    f"""WITH {READINGS}, b AS (SELECT session, CASE WHEN value = 599 THEN 59 ELSE CAST(floor((value + 1) / 10) AS INT) END AS i
      FROM readings WHERE value >= -1 AND value <= 599)
    SELECT s.session, CAST(-1 + 10 * g.i AS BIGINT) AS bin, count(b.i) AS frequency
    FROM (SELECT DISTINCT session FROM readings) s CROSS JOIN (SELECT unnest(range(60)) AS i) g
    LEFT JOIN b ON b.session = s.session AND b.i = g.i GROUP BY ALL""",
)
def fixed_width_histogram(spark, sf):
    return hist.fixed_width_histogram(readings(spark, sf), ["session"], F.col("value"), bins=60)


LIMITS = [
    (p, kind, limit)
    for p in ("PR", "HR", "RR", "SPO2")
    for kind, span in (("HIGH", range(40, 200, 20)), ("LOW", range(5, 45, 5)))
    for limit in span
]
ALARM_ROWS = READINGS + f""", limits AS (SELECT * FROM (VALUES {', '.join(str(x) for x in LIMITS)}) v(param, kind, lim)),
 ends AS (SELECT session, param, max(t) AS end_t FROM readings GROUP BY ALL),
 classed AS (SELECT r.session, r.param, kind, lim, r.t, r.seq,
    CASE WHEN kind = 'HIGH' THEN CASE WHEN value >= lim OR value = -4 THEN 1 WHEN value >= 0 OR value = -5 THEN 0
        WHEN value IN (-1, -2, -3) THEN -1 END
      ELSE CASE WHEN (value <= lim AND value >= 0) OR value = -5 THEN 1 WHEN value > lim THEN 0
        WHEN value IN (-1, -2, -3) THEN -1 END END AS state
  FROM readings r JOIN limits l ON r.param = l.param),
 moved AS (SELECT * FROM (SELECT *, lag(state) OVER (PARTITION BY session, param, kind, lim ORDER BY t, seq) AS was
    FROM classed WHERE state IS NOT NULL) WHERE was IS NULL OR was <> state),
 spanned AS (SELECT m.*, coalesce(lead(t) OVER w, end_t) AS stop,
    sum(CASE WHEN state = 0 THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS grp
  FROM moved m JOIN ends e ON m.session = e.session AND m.param = e.param
  WINDOW w AS (PARTITION BY m.session, m.param, kind, lim ORDER BY t, seq)),
 grouped AS (SELECT session, param, kind, lim, grp, min(CASE WHEN state = 1 THEN t END) AS start, max(stop) AS stop,
    sum(CASE WHEN state = 1 THEN stop - t ELSE 0 END) AS gain, sum(CASE WHEN state = 0 THEN 30 * (stop - t) ELSE 0 END) AS leak
  FROM spanned GROUP BY ALL),
 summed AS (SELECT *, sum(gain) OVER w - gain - sum(leak) OVER w AS s FROM grouped
  WINDOW w AS (PARTITION BY session, param, kind, lim ORDER BY grp ROWS UNBOUNDED PRECEDING)),
 found AS (SELECT session, param, kind, lim, start, stop, stop - start - gain AS xx,
    s - least(0, min(s) OVER (PARTITION BY session, param, kind, lim ORDER BY grp ROWS UNBOUNDED PRECEDING)) + gain AS bucket
  FROM summed QUALIFY start IS NOT NULL)"""


def _limits(spark):
    params = ("PR", "HR", "RR", "SPO2")
    high = {(p, "HIGH"): (40, 180, 20) for p in params}
    return al.limit_table(spark, {**high, **{(p, "LOW"): (5, 40, 5) for p in params}})


@query(
    "W4_threshold_alarms",
    f"""WITH {ALARM_ROWS} SELECT session, param, kind, CAST(lim AS BIGINT) AS "limit", start, stop, xx, bucket FROM found""",
)
def threshold_alarms(spark, sf):
    return al.threshold_alarms(readings(spark, sf), _limits(spark))


@query(
    "A9_alarm_sweep",
    f"""WITH {ALARM_ROWS} SELECT session, param, kind, CAST(lim AS BIGINT) AS "limit", delay, count(*) AS alarms,
    CAST(trunc(sum(stop - start - xx)) AS BIGINT) AS time_over_threshold
    FROM found JOIN (SELECT unnest(range(0, 864001, 43200)) AS delay) d ON bucket >= delay GROUP BY ALL""",
)
def alarm_sweep(spark, sf):
    alarms = al.threshold_alarms(readings(spark, sf), _limits(spark))
    return al.delay_sweep(alarms, last=864000, step=43200)


@query(
    "A4_alarm_histogram",
    f"""WITH {ALARM_ROWS} SELECT param, kind, CAST({BIN.format(d='(stop - start - xx)')} AS BIGINT) AS bin, count(*) AS frequency,
    CAST(trunc(sum(stop - start - xx)) AS BIGINT) AS seconds FROM found WHERE stop - start - xx >= 0 GROUP BY ALL""",
)
def alarm_duration_histogram(spark, sf):
    alarms = al.threshold_alarms(readings(spark, sf), _limits(spark))
    return hist.duration_histogram(
        alarms, ["param", "kind"], F.col("stop") - F.col("start") - F.col("xx")
    )


@query(
    "W5_deltas",
    f"""WITH {PRESSURES}, d AS (SELECT session, t, sys, dia, map, pr, error_code, min(seq) AS seq FROM bp GROUP BY ALL)
    SELECT session, t, coalesce(t - lag(t) OVER (PARTITION BY session ORDER BY t, seq), -1) AS delta_t, sys, map FROM d""",
)
def deltas(spark, sf):
    from ..operators.asof import cuff_pairs

    return cuff_pairs(cuff(spark, sf), continuous(spark, sf)).select(
        "session", "t", "delta_t", "sys", "map"
    )


@query(
    "W6_alarm_changes",
    f"""WITH {ALARMS} SELECT session, start_sn, seq, code, state,
      strftime(timezone('America/New_York', to_timestamp(t)), '%Y-%m-%d %H:%M:%S') AS local_time,
      CAST((dayofweek(timezone('America/New_York', to_timestamp(t))) + 6) % 7 AS BIGINT) AS weekday
    FROM (SELECT *, lag(code) OVER w AS pc, lag(state) OVER w AS ps FROM alarms
      WINDOW w AS (PARTITION BY session, start_sn ORDER BY t, seq))
    WHERE pc IS NULL OR (code, state) <> (pc, ps)""",
)
def alarm_changes(spark, sf):
    from ..functions import clock

    rows = runs.changes(
        device_alarms(spark, sf), ["session", "start_sn"], ["t", "seq"], F.struct("code", "state")
    )
    local = clock.local_time(F.col("t"), "America/New_York")
    return rows.select(
        "session", "start_sn", "seq", "code", "state",
        F.date_format(local, "yyyy-MM-dd HH:mm:ss").alias("local_time"),
        clock.weekday(local).cast("bigint").alias("weekday"),
    )


@query(
    "W7_consecutive_duplicates",
    f"""WITH {READINGS} SELECT session, param, seq, value FROM (
      SELECT *, lag(value < 0) OVER (PARTITION BY session, param ORDER BY t, seq) AS was FROM readings)
    WHERE was IS NULL OR was <> (value < 0)""",
)
def consecutive_duplicates(spark, sf):
    rows = runs.changes(readings(spark, sf), ["session", "param"], ["t", "seq"], F.col("value") < 0)
    return rows.select("session", "param", "seq", "value")


@query(
    "W9_sensor_off_codes",
    f"""WITH {READINGS}, {ALARMS}, fresh AS (
      SELECT * FROM (SELECT *, lag(start_sn) OVER (PARTITION BY session ORDER BY t, seq) AS was FROM alarms)
      WHERE (was IS NULL OR was <> start_sn) AND code = 33),
    spo2 AS (SELECT *, coalesce(lag(value > 0) OVER (PARTITION BY session ORDER BY t, seq), false) AS was_ok,
        max(t) OVER (PARTITION BY session) AS last_t FROM readings WHERE param = 'SPO2'),
    ev AS (SELECT session, t, 0 AS e FROM fresh UNION ALL SELECT session, t, 1 FROM spo2 WHERE value > 0 AND NOT was_ok),
    st AS (SELECT s.session, s.seq, s.t, s.value, s.last_t, arg_max(ev.e, (ev.t * 2 + ev.e)) AS state
      FROM spo2 s LEFT JOIN ev ON ev.session = s.session AND ev.t <= s.t GROUP BY ALL),
    ons AS (SELECT DISTINCT session FROM ev WHERE e = 1)
    SELECT st.session, seq, t, CASE WHEN state = 0 AND ons.session IS NOT NULL AND t < last_t AND value < 0 AND value > -4
      THEN -10 ELSE value END AS value FROM st LEFT JOIN ons ON ons.session = st.session""",
)
def sensor_off_codes(spark, sf):
    spo2 = readings(spark, sf).where("param = 'SPO2'")
    return budget.sensor_off_codes(spo2, device_alarms(spark, sf)).select("session", "seq", "t", "value")


@query(
    "W11_interval_differences",
    f"""WITH {READINGS} SELECT session, seq, value - coalesce(lag(value) OVER w, value) AS drr,
      CAST(coalesce((value > lag(value) OVER w AND value > lead(value) OVER w) OR (value < lag(value) OVER w AND value < lead(value) OVER w), false) AS INT) AS turn
    FROM readings WHERE param = 'HR' WINDOW w AS (PARTITION BY session ORDER BY t, seq)""",
)
def interval_differences(spark, sf):
    from ..operators.features import interval_differences as differences

    beats = readings(spark, sf).where("param = 'HR'").withColumnRenamed("value", "rr")
    return differences(beats).select("session", "seq", "drr", "turn")


@query(
    "W12_gap_fill",
    f"""WITH {READINGS}, n AS (SELECT *, lead(t) OVER (PARTITION BY session, param ORDER BY t, seq) AS nt FROM readings)
    SELECT session, param, t, value, 0 AS inserted FROM n
    UNION ALL SELECT session, param, t + {RATE}, 100.0, 1 FROM n WHERE nt - t > {RATE}""",
)
def gap_fill(spark, sf):
    out = al.gap_filled(readings(spark, sf), 100.0, RATE, keys=("session", "param"))
    return out.select("session", "param", "t", "value", "inserted")


OVERLAY = DROPOUTS + """, pairs_xx AS (SELECT session, param, start, stop FROM runs WHERE param IN ('PR', 'HR')),
 pairs_do AS (SELECT session, param, start, stop FROM dropouts WHERE param IN ('PR', 'HR')),
 has AS (SELECT session, bool_or(param = 'PR') AS has_pr, bool_or(param = 'HR') AS has_hr FROM readings GROUP BY ALL)"""


def _overlay(spark, sf):
    base = readings(spark, sf).where("param in ('PR', 'HR')")
    marks = runs.numbered(runs.marked(base, RATE))
    low = F.lower("param")
    invalid = runs.state_runs(marks, RATE).select(
        "session", F.concat(low, F.lit("_xx")).alias("layer"), "start", "stop"
    )
    gaps = runs.dropouts(marks, RATE).select(
        "session", F.concat(low, F.lit("_drop")).alias("layer"), "start", "stop"
    )
    limits = al.limit_table(spark, {("PR", "HIGH"): (60, 60), ("HR", "HIGH"): (60, 60)})
    alarms = al.threshold_alarms(base, limits).select(
        "session", F.concat(low, F.lit("_alarm")).alias("layer"), "start", "stop"
    )
    presence = readings(spark, sf).groupBy("session").agg(
        F.bool_or(F.col("param") == "PR").alias("has_pr"), F.bool_or(F.col("param") == "HR").alias("has_hr")
    )
    checked = balance(base, ["session"], "t")
    return al.cardiac_cut(invalid.unionByName(gaps).unionByName(alarms), presence, checked)


def _swept_sql(layers: str, condition: str) -> str:
    """Interval algebra by elementary segments: a condition on covering layers."""
    return f"""{layers}, edges AS (SELECT session, start AS t FROM lay UNION SELECT session, stop FROM lay),
     seg AS (SELECT session, t AS a, lead(t) OVER (PARTITION BY session ORDER BY t) AS b FROM edges),
     cov AS (SELECT seg.session, a, b, {', '.join(f"coalesce(bool_or(layer = '{x}'), false) AS {x}" for x in al.CARDIAC_LAYERS)}
       FROM seg LEFT JOIN lay ON lay.session = seg.session AND lay.start <= a AND lay.stop >= b
       WHERE b IS NOT NULL GROUP BY seg.session, a, b),
     hit AS (SELECT cov.session, a, b FROM cov JOIN has ON has.session = cov.session WHERE {condition}),
     isl AS (SELECT *, sum(CASE WHEN pb = a THEN 0 ELSE 1 END) OVER (PARTITION BY session ORDER BY a ROWS UNBOUNDED PRECEDING) AS g
       FROM (SELECT *, lag(b) OVER (PARTITION BY session ORDER BY a) AS pb FROM hit))
     SELECT session, min(a) AS start, max(b) AS stop FROM isl GROUP BY session, g"""


_LAY = OVERLAY + """, xlim AS (SELECT 1)""" + """, lay0 AS (
  SELECT session, lower(param) || '_xx' AS layer, start, stop FROM pairs_xx
  UNION ALL SELECT session, lower(param) || '_drop', start, stop FROM pairs_do)"""


def _alarm_layer() -> str:
    inner = ALARM_ROWS[len(READINGS) :]
    start = inner.index("limits AS (")
    stop = inner.index("ends AS (")
    return inner[:start] + "limits AS (SELECT * FROM (VALUES ('PR', 'HIGH', 60), ('HR', 'HIGH', 60)) v(param, kind, lim)),\n " + inner[stop:]


_LAYERS = (
    _LAY
    + _alarm_layer()
    + """, lay AS (SELECT * FROM (SELECT * FROM lay0 UNION ALL SELECT session, lower(param) || '_alarm', start, stop FROM found) WHERE stop > start)"""
)


@query(
    "W21_cardiac_invalid",
    "WITH " + _swept_sql(_LAYERS, "(has_pr OR has_hr) AND (pr_xx OR NOT has_pr) AND (hr_xx OR NOT has_hr)"),
)
def cardiac_invalid(spark, sf):
    return al.cardiac_invalid(_overlay(spark, sf))


@query("W21_cardiac_dropout", "WITH " + _swept_sql(_LAYERS, "pr_drop AND hr_drop"))
def cardiac_dropout(spark, sf):
    return al.cardiac_dropout(_overlay(spark, sf))


@query(
    "W21_cardiac_alarms",
    "WITH " + _swept_sql(_LAYERS, "CASE WHEN pr_xx THEN hr_alarm ELSE pr_alarm END"),
)
def cardiac_alarms(spark, sf):
    return al.cardiac_alarms(_overlay(spark, sf))


EXPORTED = ["PR", "HR", "SPO2", "RR"]
WINDOW = 21600


def _cell_sql(p: str) -> str:
    v = f"CASE WHEN param = '{p}' THEN value END"
    return f"""CASE WHEN count(CASE WHEN param = '{p}' THEN 1 END) = 0 THEN NULL
      WHEN count(CASE WHEN param = '{p}' AND value > -1 THEN 1 END) > 0
        THEN CAST(CAST(trunc(median(CASE WHEN param = '{p}' AND value > -1 THEN value END)) AS BIGINT) AS VARCHAR)
      WHEN bool_or({v} < 0 AND {v} > -4) THEN 'XX' WHEN bool_or({v} = -4) THEN '++' ELSE '--' END AS {p.lower()}"""


EXPORT = READINGS + f""", {ALARMS}, tt AS (SELECT session, t FROM readings WHERE param IN ('PR', 'HR', 'SPO2', 'RR') UNION ALL SELECT session, t FROM alarms),
 sp AS (SELECT session, floor(min(t)) AS t0, ceil(max(t)) AS t1 FROM tt GROUP BY session),
 grid AS (SELECT session, t0, unnest(range(CAST(ceil((t1 + {WINDOW} - t0) / {WINDOW}) AS BIGINT))) AS w FROM sp),
 cells AS (SELECT r.session, CAST(floor((t - t0) / {WINDOW}) AS BIGINT) AS w, {', '.join(_cell_sql(p) for p in EXPORTED)}
   FROM readings r JOIN sp ON sp.session = r.session WHERE param IN ('PR', 'HR', 'SPO2', 'RR') GROUP BY 1, 2),
 txt AS (SELECT session, w, string_agg(txt, ' ' ORDER BY txt) AS alarms FROM (
   SELECT DISTINCT a.session, CAST(floor((t - t0) / {WINDOW}) AS BIGINT) AS w, 'code ' || code AS txt
   FROM alarms a JOIN sp ON sp.session = a.session WHERE code < 30) GROUP BY ALL),
 dev AS (SELECT session, max(t) AS t, block + 100 AS device FROM readings GROUP BY session, block),
 rows_ AS (SELECT g.session, t0 + g.w * {WINDOW} AS t, pr, hr, spo2, rr, alarms FROM grid g
   LEFT JOIN cells c ON c.session = g.session AND c.w = g.w LEFT JOIN txt x ON x.session = g.session AND x.w = g.w)"""


@query(
    "W10_windowed_export",
    f"""WITH {EXPORT} SELECT rows_.session, CAST(CAST(rows_.t + {WINDOW // 2} AS BIGINT) AS VARCHAR) AS "time",
      coalesce(arg_min(dev.device, dev.t), any_value(l.device)) AS device, pr, hr, spo2, rr, alarms
    FROM rows_ LEFT JOIN dev ON dev.session = rows_.session AND dev.t >= rows_.t
    LEFT JOIN (SELECT session, max(device) AS device FROM dev GROUP BY session) l ON l.session = rows_.session
    GROUP BY rows_.session, rows_.t, pr, hr, spo2, rr, alarms""",
)
def windowed_export(spark, sf):
    r = readings(spark, sf)
    codes_ = literal_table(spark, [(i, f"code {i}") for i in range(40)], "code bigint, text string")
    devices = r.groupBy("session", "block").agg(F.max("t").alias("t")).select(
        "session", "t", (F.col("block") + 100).alias("device")
    )
    everything = device_alarms(spark, sf).withColumn("code", F.when(F.col("code") < 30, F.col("code")).otherwise(999))
    return export.windowed_export(
        r, EXPORTED, float(WINDOW), {"alarms": (everything, codes_)}, devices
    )


@query(
    "C4_numerics_export",
    f"""WITH {EXPORT} SELECT session, strftime(timezone('America/New_York', to_timestamp(t + {WINDOW // 2})), '%Y-%m-%d %H:%M:%S') AS "time",
    pr, hr, spo2, rr FROM rows_ WHERE coalesce(pr, hr, spo2, rr) IS NOT NULL""".replace(
        " UNION ALL SELECT session, t FROM alarms)", ")"
    ),
)
def numerics_export(spark, sf):
    return export.windowed_export(
        readings(spark, sf), EXPORTED, float(WINDOW), zone="America/New_York", keep_empty=False
    )


SUMMARY = ["HR", "PR", "RR", "SPO2", "TIME_SYNC"]


@query(
    "A24_session_summary",
    f"""WITH {SESSION_TIMES} SELECT s.session, CAST(round_even(wrist_active, 0) AS BIGINT) AS duration,
      CAST(round_even(wrist_active, 0) AS BIGINT) AS time_wt, CAST(round_even(cable_active, 0) AS BIGINT) AS time_cable,
      CAST(round_even(session_active, 0) AS BIGINT) AS time_total, CAST(round_even(session_on_network, 0) AS BIGINT) AS time_on_network,
      {', '.join(f"CAST(max(CASE WHEN param = '{p}' THEN round_even(active, 0) END) AS BIGINT) AS time_{p.lower()}, CAST(max(CASE WHEN param = '{p}' THEN round_even(xx, 0) END) AS BIGINT) AS time_in_xx_{p.lower()}, round(CAST(max(CASE WHEN param = '{p}' THEN display_pct END) AS DOUBLE), 2) AS display_percent_{p.lower()}" for p in SUMMARY)}
    FROM session_times s JOIN times t ON t.session = s.session GROUP BY ALL""",
)
def session_summary(spark, sf):
    times = budget.parameter_times(readings(spark, sf), RATE)
    return budget.session_summary(times, budget.session_times(times), SUMMARY)


@query(
    "A24_spot_times",
    f"""WITH {PRESSURES}, r AS (SELECT session, unnest(['BP_SYS', 'BP_DIA', 'BP_MAP']) AS param, unnest([sys, dia, map]) AS value FROM bp),
    g AS (SELECT session, param, CAST(count(*) AS DOUBLE) AS active, CAST(sum(CASE WHEN value < 0 AND value > -4 THEN 1 ELSE 0 END) AS DOUBLE) AS xx FROM r GROUP BY ALL)
    SELECT *, 100.0 * (active - xx) / active AS display_pct FROM g""",
)
def spot_times(spark, sf):
    cuffs = codes.components(cuff(spark, sf), "BP", ("session", "sn", "t"))
    return budget.spot_times(cuffs).select("session", "param", "active", "xx", "display_pct")


@query(
    "A17_drift_alerts",
    f"""WITH {PRESSURES}, cal AS (SELECT session, t, seq, map AS cal FROM bp WHERE map > 0),
    hit AS (SELECT c.session, c.t, c.seq, c.map AS value, k.t AS cal_t, k.seq AS cal_seq, k.cal FROM cnibp c
      ASOF JOIN cal k ON c.session = k.session AND c.t >= k.t),
    v AS (SELECT *, CASE WHEN value IN (-1, -2, -6, -7, -8, -9, -10) THEN cal WHEN value = -4 THEN 240.0 WHEN value = -5 THEN 40.0 ELSE value END AS x FROM hit),
    n AS (SELECT *, lead(t) OVER (PARTITION BY session, cal_t ORDER BY t, seq) AS nt FROM v),
    f AS (SELECT session, cal_t, cal, t, 0 AS ins, seq, x FROM n UNION ALL SELECT session, cal_t, cal, t + 86400, 1, seq, cal FROM n WHERE nt - t > 86400),
    a AS (SELECT *, x >= cal * 1.3 OR x <= cal * 0.7 AS alert FROM f),
    b AS (SELECT *, lag(alert) OVER w AS was, lead(t) OVER w AS nxt FROM a WINDOW w AS (PARTITION BY session, cal_t ORDER BY t, ins, seq)),
    c AS (SELECT *, sum(CASE WHEN alert AND NOT coalesce(was, false) THEN 1 ELSE 0 END) OVER (PARTITION BY session, cal_t ORDER BY t, ins, seq ROWS UNBOUNDED PRECEDING) AS run,
      bool_or(coalesce(alert <> was, false)) OVER (PARTITION BY session, cal_t) AS moves FROM b),
    d AS (SELECT session, cal_t, run, max(coalesce(nxt, t)) - min(t) AS len FROM c WHERE alert AND moves GROUP BY ALL)
    SELECT session, count(*) AS alerts, sum(len - 3600) AS seconds FROM d WHERE len >= 3600 GROUP BY session""",
)
def drift_alerts(spark, sf):
    rows = continuous(spark, sf).select("session", "t", "seq", F.col("map").alias("value"))
    cal = cuff(spark, sf).where("map > 0").select("session", "t", "seq", F.col("map").alias("value"))
    return al.drift_alerts(rows, cal, 3600.0, missing=86400.0)


@query(
    "A18_lost_alerts",
    f"""WITH {PRESSURES}, v AS (SELECT session, t, seq, CASE WHEN map = -4 THEN 240.0 WHEN map = -5 THEN 40.0 ELSE map END AS x FROM cnibp),
    n AS (SELECT *, lead(t) OVER (PARTITION BY session ORDER BY t, seq) AS nt FROM v),
    f AS (SELECT session, t, 0 AS ins, seq, x FROM n UNION ALL SELECT session, t + 86400, 1, seq, 100.0 FROM n WHERE nt - t > 86400),
    b AS (SELECT *, x < 0 AS alert, lag(x < 0) OVER w AS was, lead(t) OVER w AS nxt FROM f WINDOW w AS (PARTITION BY session ORDER BY t, ins, seq)),
    c AS (SELECT *, sum(CASE WHEN alert AND NOT coalesce(was, false) THEN 1 ELSE 0 END) OVER (PARTITION BY session ORDER BY t, ins, seq ROWS UNBOUNDED PRECEDING) AS run,
      bool_or(coalesce(alert <> was, false)) OVER (PARTITION BY session) AS moves FROM b),
    d AS (SELECT session, run, max(coalesce(nxt, t)) - min(t) AS len FROM c WHERE alert AND moves GROUP BY ALL)
    SELECT session, count(*) AS alerts, sum(len - 3600) AS seconds FROM d WHERE len >= 3600 GROUP BY session""",
)
def lost_alerts(spark, sf):
    rows = continuous(spark, sf).select("session", "t", "seq", F.col("map").alias("value"))
    return al.lost_alerts(rows, 3600.0, missing=86400.0)


@query(
    "C1_session_mining",
    f"""WITH {DROPOUTS}, x AS (SELECT session, param, count(*) AS invalid_runs, sum(stop - start) AS invalid_seconds FROM runs GROUP BY ALL),
    d AS (SELECT session, param, count(*) AS dropouts, sum(stop - start) AS dropout_seconds FROM dropouts GROUP BY ALL)
    SELECT coalesce(x.session, d.session) AS session, coalesce(x.param, d.param) AS param, coalesce(invalid_runs, 0) AS invalid_runs,
      coalesce(invalid_seconds, 0.0) AS invalid_seconds, coalesce(dropouts, 0) AS dropouts, coalesce(dropout_seconds, 0.0) AS dropout_seconds
    FROM x FULL JOIN d ON x.session = d.session AND x.param = d.param""",
)
def session_mining(spark, sf):
    marks = _numbered(spark, sf)
    span = F.sum(F.col("stop") - F.col("start"))
    x = runs.state_runs(marks, RATE).groupBy("session", "param").agg(
        F.count(F.lit(1)).alias("invalid_runs"), span.alias("invalid_seconds")
    )
    d = runs.dropouts(marks, RATE).groupBy("session", "param").agg(
        F.count(F.lit(1)).alias("dropouts"), span.alias("dropout_seconds")
    )
    return x.join(d, ["session", "param"], "full").fillna(0).fillna(0.0)


@query("C1_result_tables")
def result_tables(spark, sf):
    """Row counts of every mined table, in one plan."""
    out = mining.mine(
        spark, readings(spark, sf), cuff(spark, sf), continuous(spark, sf),
        device_alarms(spark, sf).select("session", "t", "code", "severity", "state", "start_sn"),
    )
    frames = [
        df.groupBy(F.lit(name).alias("result")).agg(F.count(F.lit(1)).alias("n"))
        for name, df in sorted(out.items())
    ]
    total = frames[0]
    for f in frames[1:]:
        total = total.unionByName(f)
    return total


def _sweep_sql() -> str:
    """Every limit and delay on an axis of its own: elementary segments, then islands."""
    inner = ALARM_ROWS[len(READINGS) :]
    start, stop = inner.index("limits AS ("), inner.index("ends AS (")
    limits = ", ".join(f"('{p}', 'HIGH', {x})" for p in ("PR", "HR") for x in (60, 100, 140))
    alarms = inner[:start] + f"limits AS (SELECT * FROM (VALUES {limits}) v(param, kind, lim)),\n " + inner[stop:]
    return f"""WITH {OVERLAY}{alarms}, d AS (SELECT unnest(range(0, 864001, 43200)) AS delay),
     al AS (SELECT session, lim, delay, param, start, stop FROM found JOIN d ON bucket > delay WHERE stop > start),
     k AS (SELECT DISTINCT session, lim, delay FROM al),
     lay AS (SELECT session, lim, delay, lower(param) || '_alarm' AS layer, start, stop FROM al
       UNION ALL SELECT k.session, lim, delay, 'pr_xx', start, stop FROM pairs_xx x JOIN k ON k.session = x.session WHERE param = 'PR' AND stop > start),
     edges AS (SELECT session, lim, delay, start AS t FROM lay UNION SELECT session, lim, delay, stop FROM lay),
     seg AS (SELECT session, lim, delay, t AS a, lead(t) OVER (PARTITION BY session, lim, delay ORDER BY t) AS b FROM edges),
     cov AS (SELECT seg.session, seg.lim, seg.delay, a, b, bool_or(layer = 'pr_xx') AS pr_xx, bool_or(layer = 'pr_alarm') AS pr_alarm,
         bool_or(layer = 'hr_alarm') AS hr_alarm
       FROM seg JOIN lay ON lay.session = seg.session AND lay.lim = seg.lim AND lay.delay = seg.delay AND start <= a AND stop >= b
       WHERE b IS NOT NULL GROUP BY ALL),
     hit AS (SELECT * FROM cov WHERE CASE WHEN pr_xx THEN hr_alarm ELSE pr_alarm END),
     isl AS (SELECT *, sum(CASE WHEN pb = a THEN 0 ELSE 1 END) OVER (PARTITION BY session, lim, delay ORDER BY a ROWS UNBOUNDED PRECEDING) AS g
       FROM (SELECT *, lag(b) OVER (PARTITION BY session, lim, delay ORDER BY a) AS pb FROM hit))
     SELECT session, 'HIGH' AS kind, CAST(lim AS BIGINT) AS "limit", CAST(delay AS BIGINT) AS delay, count(DISTINCT g) AS alarms,
       CAST(trunc(sum(b - a)) AS BIGINT) AS time_over_threshold FROM isl GROUP BY ALL"""


@query("C1_cardiac_sweep", _sweep_sql())
def cardiac_sweep_rows(spark, sf):
    """Cardiac-rate alarms at three limits and all delays."""
    base = readings(spark, sf).where("param in ('PR', 'HR')")
    alarms = al.threshold_alarms(base, al.limit_table(spark, {(p, "HIGH"): (60, 140, 40) for p in ("PR", "HR")}))
    pulse = runs.numbered(runs.marked(base.where("param = 'PR'"), RATE))
    invalid = runs.state_runs(pulse, RATE).select("session", "start", "stop")
    return cardiac.cardiac_sweep(alarms, invalid, last=864000, step=43200, width=86400.0)
