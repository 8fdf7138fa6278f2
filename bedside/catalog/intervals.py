"""Interval merging, labels, census and site health."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import MARK_TAGS
from ..operators import ranges, runs
from ..plans import site_health as health
from ..sources import sinks
from ..sources import tables as stored
from . import query
from .base import (
    READINGS,
    SESSIONS,
    SPANS,
    START,
    SWEPT_SQL,
    merged_sql,
    readings,
    sessions,
    site_defaults,
    spans,
    swept_alarms,
    table,
)


@query(
    "W8_device_islands",
    f"""WITH {READINGS}, x AS (SELECT session, seq, t, param, CASE WHEN param = lag(param) OVER w THEN 0 ELSE 1 END AS fresh FROM readings WINDOW w AS (PARTITION BY session ORDER BY t, seq)),
    y AS (SELECT *, sum(fresh) OVER (PARTITION BY session ORDER BY t, seq ROWS UNBOUNDED PRECEDING) AS island FROM x)
    SELECT session, CAST(island AS BIGINT) AS island, param, min(t) AS start, max(t) AS stop, count(*) AS n FROM y GROUP BY ALL""",
)
def device_islands(spark, sf):
    """Consecutive readings of one source; the label plays the device."""
    return runs.islands(readings(spark, sf), ["session"], ["t", "seq"], "param", "t", "t")


MERGED = SPANS + ", " + merged_sql("spans", "merged", "session")


@query(
    "W13_merged_intervals",
    f"""WITH {MERGED} SELECT session, "begin", "end", CAST(merged AS BIGINT) AS merged FROM merged""",
)
def merged_intervals(spark, sf):
    return runs.merge_intervals(spans(spark, sf), ["session"], "begin", "end")


def _rhythm_sql(kind: str) -> str:
    row = {
        "VFIB": ("greatest(sn - 12288, 0)", "sn + 500", "code > 0 AND code < 10 AND (code & 2) > 0"),
        "AFIB": ("greatest(sn - 98000, 0)", "sn + 500", "code = 1"),
        "ASYS": ("sn - 1000", "sn", "code > 0 AND code < 10 AND (code & 4) > 0"),
    }[kind]
    return f"""WITH {READINGS}, rows_ AS (SELECT session, CAST({row[0]} AS BIGINT) AS "begin", CAST({row[1]} AS BIGINT) AS "end"
      FROM (SELECT session, sn, seq % 12 AS code FROM readings) WHERE {row[2]}), {merged_sql('rows_', 'merged', 'session')}
    SELECT session, "begin", "end", CAST(merged AS BIGINT) AS merged, '{kind}' AS tag FROM merged"""


def _rhythm(spark, sf):
    return readings(spark, sf).select("session", "sn", (F.col("seq") % 12).alias("code"))


for _kind in ("VFIB", "AFIB", "ASYS"):
    query(f"W13_rhythm_{_kind.lower()}", _rhythm_sql(_kind))(
        lambda spark, sf, kind=_kind: runs.rhythm_intervals(_rhythm(spark, sf), kind)
    )


MARK_LIST = [*MARK_TAGS, "+(B", "N"]
_TAG = "CASE mark " + " ".join(f"WHEN '{m}' THEN '{t}'" for m, t in MARK_TAGS.items()) + " ELSE 'OTHER' END"


@query(
    "W14_marks_to_intervals",
    f"""WITH {READINGS}, m AS (SELECT session, t, seq, [{', '.join(f"'{m}'" for m in MARK_LIST)}][seq % {len(MARK_LIST)} + 1] AS mark FROM readings),
    k AS (SELECT *, {_TAG} AS tag, lead(t) OVER (PARTITION BY session ORDER BY t, seq) AS nt FROM m WHERE mark <> 'N' AND t <= {START + 2000000})
    SELECT session, start, stop, tag FROM (SELECT session, greatest(t, {START + 100000}) AS start, least(coalesce(nt, {START + 2000000}), {START + 2000000}) AS stop, tag FROM k) WHERE start < stop""",
)
def marks_to_intervals(spark, sf):
    names = F.array(*[F.lit(m) for m in MARK_LIST])
    marks = readings(spark, sf).select(
        "session", "t", "seq", F.get(names, (F.col("seq") % len(MARK_LIST)).cast("int")).alias("mark")
    )
    marks = marks.withColumn("symbol", F.substring("mark", 1, 1))
    return runs.marks_to_intervals(marks, F.lit(START + 100000.0), F.lit(START + 2000000.0), MARK_TAGS)


DETECTED = (
    SPANS
    + """, ra AS (SELECT session, "begin" * 10 AS "begin", "begin" * 10 + ("end" - "begin") % 7 AS "end" FROM spans WHERE tag = 'R' AND ("end" - "begin") % 7 > 0),
 db AS (SELECT session, "begin" * 10 + 2 AS "begin", "begin" * 10 + 2 + ("end" - "begin") % 5 AS "end" FROM spans WHERE tag <> 'R' AND ("end" - "begin") % 5 > 0), """
    + merged_sql("ra", "r1", "session")
    + ", "
    + merged_sql("db", "d1", "session")
)


def _episodes(spark, sf):
    s = spans(spark, sf)
    length = F.col("end") - F.col("begin")
    a = s.where("tag = 'R'").select("session", (F.col("begin") * 10).alias("begin"), (F.col("begin") * 10 + length % 7).alias("end"))
    b = s.where("tag <> 'R'").select("session", (F.col("begin") * 10 + 2).alias("begin"), (F.col("begin") * 10 + 2 + length % 5).alias("end"))
    return tuple(
        runs.merge_intervals(x.where("end > begin"), ["session"], "begin", "end") for x in (a, b)
    )


@query(
    "J19_episode_comparison",
    f"""WITH {DETECTED}, rr AS (SELECT session, "begin", "end", (SELECT count(*) FROM d1 WHERE d1.session = r1.session AND d1."begin" < r1."end" AND r1."begin" < d1."end") AS hits,
      (SELECT coalesce(sum(least(d1."end", r1."end") - greatest(d1."begin", r1."begin")), 0) FROM d1 WHERE d1.session = r1.session AND d1."begin" < r1."end" AND r1."begin" < d1."end") AS shared FROM r1),
    dd AS (SELECT session, "begin", "end", (SELECT count(*) FROM r1 WHERE d1.session = r1.session AND d1."begin" < r1."end" AND r1."begin" < d1."end") AS hits FROM d1),
    ra1 AS (SELECT session, count(*) AS re, sum(CASE WHEN hits > 0 THEN 1 ELSE 0 END) AS rh, sum("end" - "begin") AS rt, sum(shared) AS st FROM rr GROUP BY ALL),
    da1 AS (SELECT session, count(*) AS de, sum(CASE WHEN hits > 0 THEN 1 ELSE 0 END) AS dh, sum("end" - "begin") AS dt FROM dd GROUP BY ALL)
    SELECT coalesce(a.session, b.session) AS session, coalesce(re, 0) AS reference_episodes, CAST(coalesce(rh, 0) AS BIGINT) AS reference_hit,
      CAST(coalesce(rt, 0) AS BIGINT) AS reference_time, CAST(coalesce(st, 0) AS BIGINT) AS shared_time, coalesce(de, 0) AS detected_episodes,
      CAST(coalesce(dh, 0) AS BIGINT) AS detected_hit, CAST(coalesce(dt, 0) AS BIGINT) AS detected_time,
      CAST(rh AS DOUBLE) / nullif(re, 0) AS episode_sensitivity, CAST(dh AS DOUBLE) / nullif(de, 0) AS episode_predictivity,
      CAST(st AS DOUBLE) / nullif(rt, 0) AS duration_sensitivity, CAST(coalesce(st, 0) AS DOUBLE) / nullif(dt, 0) AS duration_predictivity
    FROM ra1 a FULL JOIN da1 b ON a.session = b.session""",
)
def episode_comparison(spark, sf):
    a, b = _episodes(spark, sf)
    names = lambda x: x.select("session", F.col("begin").alias("start"), F.col("end").alias("stop"))
    return ranges.compare_episodes(names(a), names(b), width=365.0)


@query(
    "U11_on_off_delays",
    f"""WITH RECURSIVE {DETECTED}, o AS (SELECT session, "begin" AS b, "end" AS e, row_number() OVER (PARTITION BY session ORDER BY "begin") AS i FROM r1),
    f(session, i, s, x) AS (
      SELECT session, i, CASE WHEN e - b > 4 THEN b + 4 END, CASE WHEN e - b > 4 THEN e + 15 END FROM o WHERE i = 1
      UNION ALL SELECT o.session, o.i, CASE WHEN b < x THEN s WHEN e - b > 4 THEN b + 4 END,
        CASE WHEN b < x THEN greatest(x, e + 15) WHEN e - b > 4 THEN e + 15 END FROM f JOIN o ON o.session = f.session AND o.i = f.i + 1)
    SELECT session, CAST(s AS BIGINT) AS "begin", CAST(max(x) AS BIGINT) AS "end" FROM f WHERE s IS NOT NULL GROUP BY session, s""",
)
def on_off_delays(spark, sf):
    a, _ = _episodes(spark, sf)
    return runs.apply_delays(a, 4, 15)


@query(
    "J7_modules_at_log_time",
    f"""WITH {READINGS}, m AS (SELECT session AS device_id, param AS module, block, min(t) AS start, max(t) AS stop FROM readings GROUP BY ALL)
    SELECT r.seq AS log_id, string_agg(DISTINCT m.module, ' ' ORDER BY m.module) AS modules FROM readings r
    JOIN m ON m.device_id = r.session AND r.t >= m.start AND r.t <= m.stop GROUP BY r.seq""",
)
def modules_at_log_time(spark, sf):
    r = readings(spark, sf)
    modules = r.groupBy(F.col("session").alias("device_id"), F.col("param").alias("module"), "block").agg(
        F.min("t").alias("start"), F.max("t").alias("stop")
    )
    logs = r.select(F.col("seq").alias("log_id"), F.col("session").alias("device_id"), "t")
    out = ranges.modules_at(logs, modules)
    return out.select("log_id", F.array_join("modules", " ").alias("modules"))


def _chunks(spark, sf):
    """Binding: 32 line items of a supplier in order make a chunk of two segments."""
    li = table(spark, sf, "lineitem")
    return li.groupBy(
        F.col("l_suppkey").alias("session"),
        (F.col("l_orderkey") % 2).alias("segment"),
        F.floor(F.col("l_orderkey") / 640).alias("num"),
    ).agg(
        (F.min("l_orderkey") * 3000).alias("sn0"), (F.max("l_orderkey") * 3000 + 2000).alias("sn1")
    )


CHUNKS = """chunks AS (SELECT l_suppkey AS session, l_orderkey % 2 AS segment, l_orderkey // 640 AS num,
  min(l_orderkey) * 3000 AS sn0, max(l_orderkey) * 3000 + 2000 AS sn1 FROM lineitem GROUP BY ALL)"""
BLOCKS = CHUNKS + """, segs AS (SELECT session, segment, arg_min(sn0, num) AS lo, arg_max(sn1, num) AS hi FROM chunks GROUP BY ALL),
 sized AS (SELECT *, hi - lo AS len, greatest(CAST(round_even((hi - lo) / 500 / 60.0 / 120, 0) AS BIGINT), 1) AS n FROM segs WHERE hi > lo),
 steps AS (SELECT *, CAST(ceil(len / n) AS BIGINT) AS size, sum(n) OVER (PARTITION BY session ORDER BY segment ROWS UNBOUNDED PRECEDING) - n AS base FROM sized),
 blocks AS (SELECT session, segment, CAST(base + i AS BIGINT) AS num, lo + i * size AS min_sn, least(lo + (i + 1) * size - 1, hi) AS max_sn
   FROM (SELECT *, unnest(range(n)) AS i FROM steps))"""


@query("W16_planned_blocks", f"WITH {BLOCKS} SELECT * FROM blocks")
def planned_blocks(spark, sf):
    return stored.planned_blocks(_chunks(spark, sf))


@query(
    "J8_chunks_of_blocks",
    f"""WITH {BLOCKS} SELECT b.session, b.segment, b.num AS block, c.num AS chunk, b.min_sn, b.max_sn FROM blocks b
    JOIN chunks c ON c.session = b.session AND c.segment = b.segment AND c.sn0 <= b.max_sn AND b.min_sn <= c.sn1""",
)
def chunks_of_blocks(spark, sf):
    return stored.chunks_of_planned_blocks(_chunks(spark, sf))


WINDOWS = SPANS + """, wins AS (SELECT DISTINCT session, "begin" * 8 AS start, "begin" * 8 + 20 AS stop FROM spans),
 ivs AS (SELECT DISTINCT session, "begin" * 8 + 5 AS "begin", "begin" * 8 + 5 + ("end" - "begin") % 30 AS "end" FROM spans WHERE tag = 'R')"""


def _windows(spark, sf):
    s = spans(spark, sf)
    w = s.select("session", (F.col("begin") * 8).alias("start"), (F.col("begin") * 8 + 20).alias("stop")).distinct()
    length = (F.col("end") - F.col("begin")) % 30
    i = s.where("tag = 'R'").select("session", (F.col("begin") * 8 + 5).alias("begin"), (F.col("begin") * 8 + 5 + length).alias("end")).distinct()
    return w, i


_FORMS = {
    "overlap": "true",
    "starts": 'i."begin" > w.start AND i."begin" < w.stop',
    "ends": 'i."end" > w.start AND i."end" < w.stop AND i."begin" <= w.start',
    "covers": 'i."begin" <= w.start AND i."end" >= w.stop',
}


def _label_sql(form: str) -> str:
    return f"""WITH {WINDOWS}, x AS (SELECT w.session, w.start, w.stop, CAST(coalesce(max(CASE WHEN i.session IS NOT NULL AND {_FORMS[form]}
      THEN greatest(0, least(w.stop, i."end") - greatest(w.start, i."begin")) / (w.stop - w.start) END), 0) AS DOUBLE) AS share
      FROM wins w LEFT JOIN ivs i ON i.session = w.session AND i."begin" <= w.stop AND i."end" >= w.start GROUP BY ALL)
    SELECT *, CASE WHEN share >= 0.5 THEN 1 ELSE 0 END AS label FROM x"""


for _form in _FORMS:
    query("J9_window_labels" if _form == "overlap" else f"J9_window_labels_{_form}", _label_sql(_form))(
        lambda spark, sf, form=_form: ranges.label_windows(*_windows(spark, sf), width=240.0, form=form)
    )


@query(
    "A13_hourly_census",
    """WITH s AS (SELECT DISTINCT user_id % 5 AS site_id, CASE WHEN event_type <> 'error' THEN event_type END AS care_unit, user_id AS device_id,
      ts AS start, ts + to_minutes(CAST(floor(value * 2) AS BIGINT)) AS stop FROM events),
    k AS (SELECT * FROM s WHERE CAST(start AS DATE) >= DATE '2024-01-02' AND CAST(stop AS DATE) <= DATE '2024-01-29' AND epoch_us(stop) - epoch_us(start) > 1800000000),
    u AS (SELECT DISTINCT site_id, care_unit FROM s),
    g AS (SELECT site_id, care_unit, CAST(d AS DATE) AS d, h, CAST(d AS TIMESTAMP) + to_hours(h) AS h0 FROM u,
      (SELECT unnest(generate_series(DATE '2024-01-02', DATE '2024-01-28', INTERVAL 1 DAY)) AS d), (SELECT unnest(range(24)) AS h))
    SELECT g.site_id, g.care_unit, CAST(g.d AS VARCHAR) AS date, g.h AS hour, count(k.device_id) AS devices FROM g
    LEFT JOIN k ON k.site_id = g.site_id AND k.care_unit IS NOT DISTINCT FROM g.care_unit AND k.start < g.h0 + INTERVAL 1 HOUR AND k.stop > g.h0
    GROUP BY ALL""",
)
def hourly_census(spark, sf):
    e = table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    s = e.select(
        (F.col("user_id") % 5).alias("site_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("care_unit"),
        F.col("user_id").alias("device_id"),
        ts.alias("start"),
        F.timestamp_micros(F.unix_micros(ts) + F.floor(F.col("value") * 2) * 60_000_000).alias("stop"),
    )
    out = ranges.hourly_census(s, s.select("site_id", "care_unit").distinct(), "2024-01-02", "2024-01-29")
    return out.withColumn("date", F.col("date").cast("string"))


FIRST, LAST = "1993-01-01", "1999-12-31"
HOURS = SESSIONS + f""", hours AS (SELECT site, care_unit, date_stop, count(*) AS sessions, CAST(sum(duration) AS DOUBLE) / 3600.0 AS hours FROM sessions
  WHERE date_stop BETWEEN DATE '{FIRST}' AND DATE '{LAST}' AND duration >= 3600 GROUP BY ALL)"""


def _text_date(df):
    return df.withColumn("date_stop", F.col("date_stop").cast("string"))


@query(
    "A10_site_hours",
    f"WITH {HOURS} SELECT site, care_unit, CAST(date_stop AS VARCHAR) AS date_stop, sessions, hours FROM hours",
)
def site_hours(spark, sf):
    return _text_date(health.site_hours(sessions(spark, sf), FIRST, LAST))


@query(
    "J14_unit_without_name",
    f"WITH {HOURS} SELECT site, CAST(date_stop AS VARCHAR) AS date_stop, sessions FROM hours WHERE care_unit IS NULL",
)
def unit_without_name(spark, sf):
    hours = health.site_hours(sessions(spark, sf), FIRST, LAST)
    return _text_date(health.one_unit(hours, None)).select("site", "date_stop", "sessions")


_CLASS = "CASE WHEN param IN ('PR', 'SPO2', 'CR') THEN time_wt WHEN param IN ('HR', 'RR', 'TEMP', 'HR_A') THEN time_cable ELSE time_cnibp END"
APD = HOURS + ", " + SWEPT_SQL + f""", apd AS (SELECT s.site, s.care_unit, s.date_stop, a.param, a.kind,
   sum(a.alarms / nullif({_CLASS.replace('param', 'a.param')} / 86400.0, 0)) AS apd FROM swept a JOIN sessions s ON s.session = a.session
   JOIN defaults d ON d.site = s.site AND d.param = a.param AND d.kind = a.kind AND d.lim = a.lim AND d.delay = a.delay
   WHERE s.date_stop BETWEEN DATE '{FIRST}' AND DATE '{LAST}' AND s.duration >= 3600 GROUP BY ALL)"""


def _apd(spark, sf):
    return health.alarms_per_day(
        swept_alarms(spark, sf), sessions(spark, sf), site_defaults(spark, sf), FIRST, LAST
    )


@query(
    "A11_alarms_per_day",
    f"WITH {APD} SELECT site, care_unit, CAST(date_stop AS VARCHAR) AS date_stop, param, kind, round(apd, 6) AS apd FROM apd",
)
def alarms_per_day(spark, sf):
    return _text_date(_apd(spark, sf)).withColumn("apd", F.round("apd", 6))


_GROUPS = {"cnibp": "'CNIBP_SYS', 'CNIBP_DIA', 'CNIBP_MAP'", "cr": "'CR'", "hr": "'HR'", "hr_a": "'HR_A'", "pr": "'PR'", "rr": "'RR'", "spo2": "'SPO2'"}
INDICATORS = APD + """, ind AS (SELECT h.site, h.care_unit, h.date_stop, h.sessions, h.hours,
  coalesce(sum(CASE WHEN a.param NOT IN ('CR', 'HR') THEN a.apd END) / h.sessions, 0) AS apd_total, """ + ", ".join(
    f"coalesce(sum(CASE WHEN a.param IN ({p}) THEN a.apd END) / h.sessions, 0) AS apd_{n}" for n, p in _GROUPS.items()
) + """ FROM hours h LEFT JOIN apd a ON a.site = h.site AND a.care_unit IS NOT DISTINCT FROM h.care_unit AND a.date_stop = h.date_stop
  GROUP BY h.site, h.care_unit, h.date_stop, h.sessions, h.hours)"""  # fmt: skip
APD_COLUMNS = ["apd_total", *[f"apd_{n}" for n in _GROUPS]]
_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in APD_COLUMNS)


def _indicators(spark, sf):
    hours = health.site_hours(sessions(spark, sf), FIRST, LAST)
    out = health.indicators(_apd(spark, sf), hours)
    return out.select(
        "site", "care_unit", "date_stop", "sessions", "hours", *[F.round(c, 6).alias(c) for c in APD_COLUMNS]
    )


@query(
    "A12_leading_indicators",
    f"WITH {INDICATORS} SELECT site, care_unit, CAST(date_stop AS VARCHAR) AS date_stop, sessions, hours, {_ROUNDED} FROM ind",
)
def leading_indicators(spark, sf):
    return _text_date(_indicators(spark, sf))


@query(
    "S11_indicator_upsert",
    f"""WITH {INDICATORS}, old AS (SELECT site, care_unit, date_stop, count(*) + 1000 AS sessions, CAST(0 AS DOUBLE) AS hours, CAST(1.5 AS DOUBLE) AS apd_total
      FROM sessions WHERE duration < 200000 GROUP BY ALL)
    SELECT coalesce(i.site, o.site) AS site, CASE WHEN o.site IS NULL THEN i.care_unit ELSE o.care_unit END AS care_unit,
      CAST(coalesce(i.date_stop, o.date_stop) AS VARCHAR) AS date_stop, coalesce(i.sessions, o.sessions) AS sessions, coalesce(i.hours, o.hours) AS hours,
      CASE WHEN o.site IS NULL THEN 0.0::DOUBLE ELSE o.apd_total END AS apd_total
    FROM old o FULL JOIN ind i ON i.site = o.site AND i.care_unit IS NOT DISTINCT FROM o.care_unit AND i.date_stop = o.date_stop""",
)
def indicator_upsert(spark, sf):
    old = (
        sessions(spark, sf)
        .where("duration < 200000")
        .groupBy("site", "care_unit", "date_stop")
        .agg((F.count(F.lit(1)) + 1000).alias("sessions"))
        .select("*", F.lit(0.0).alias("hours"), F.lit(1.5).alias("apd_total"))
    )
    fresh = _indicators(spark, sf).select("site", "care_unit", "date_stop", "sessions", "hours")
    out = sinks.upserted(old, fresh, ["site", "care_unit", "date_stop"], {"apd_total": 0.0})
    return _text_date(out)


@query(
    "C3_site_health",
    f"""WITH {INDICATORS} SELECT site, care_unit, count(*) AS days, CAST(sum(sessions) AS BIGINT) AS sessions, round(sum(hours), 4) AS hours, round(sum(apd_total), 4) AS apd_total FROM ind GROUP BY ALL""",
)
def site_health(spark, sf):
    return (
        health.indicators(_apd(spark, sf), health.site_hours(sessions(spark, sf), FIRST, LAST))
        .groupBy("site", "care_unit")
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.sum("sessions").alias("sessions"),
            F.round(F.sum("hours"), 4).alias("hours"),
            F.round(F.sum("apd_total"), 4).alias("apd_total"),
        )
    )


@query(
    "J13_session_site_alarms",
    f"""WITH {SESSIONS}, {SWEPT_SQL} SELECT s.site, a.param, a.kind, count(*) AS n, CAST(sum(a.alarms) AS BIGINT) AS alarms FROM swept a JOIN sessions s ON s.session = a.session GROUP BY ALL""",
)
def session_site_alarms(spark, sf):
    return (
        swept_alarms(spark, sf)
        .join(sessions(spark, sf).select("session", "site"), "session")
        .groupBy("site", "param", "kind")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("alarms").alias("alarms"))
    )


@query(
    "W15_continued_numbers",
    """WITH old AS (SELECT o_custkey AS session, max(o_orderkey % 50) AS top FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    SELECT o_custkey AS session, o_orderkey AS seq, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 + coalesce(top + 1, 0) AS block
    FROM orders LEFT JOIN old ON old.session = o_custkey WHERE o_orderstatus <> 'F'""",
)
def continued_numbers(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("session"), F.col("o_orderkey").alias("seq"), "o_orderstatus"
    )
    old = o.where("o_orderstatus = 'F'").select("session", (F.col("seq") % 50).alias("block"))
    return stored.continued_numbers(o.where("o_orderstatus <> 'F'").drop("o_orderstatus"), old)


@query(
    "J17_zipped_lists",
    """WITH a AS (SELECT l_orderkey AS guid, list(l_partkey ORDER BY l_linenumber, l_partkey) AS blocks FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1),
    b AS (SELECT l_orderkey AS guid, list(l_suppkey ORDER BY l_linenumber, l_suppkey) AS numbers FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
    SELECT a.guid, unnest(blocks) AS chunk, unnest(numbers) AS block FROM a JOIN b ON a.guid = b.guid WHERE len(blocks) = len(numbers)""",
)
def zipped_lists(spark, sf):
    li = table(spark, sf, "lineitem")

    def lists(status, column, name):
        return li.where(F.col("l_linestatus") == status).groupBy(F.col("l_orderkey").alias("guid")).agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("l_linenumber", F.col(column).alias("v")))), lambda s: s["v"]
            ).alias(name)
        )

    return stored.zipped_blocks(lists("O", "l_partkey", "blocks"), lists("F", "l_suppkey", "numbers"))


@query(
    "J18_band_lookup",
    f"""WITH {READINGS}, b AS (SELECT session, block, min(sn) AS lo, max(sn) AS hi FROM readings WHERE param = 'PR' GROUP BY ALL),
    sp AS (SELECT r.session, r.block, CAST(ceil((sn - lo) / 15000) AS BIGINT) AS w FROM readings r JOIN b ON b.session = r.session AND b.block = r.block WHERE param = 'HR'),
    den AS (SELECT b.session, b.block, w FROM b, LATERAL (SELECT unnest(range(1, CAST(ceil((hi - lo) / 15000) AS BIGINT))) AS w)),
    dc AS (SELECT den.session, den.block, den.w, count(sp.w) / 30.0 AS density FROM den LEFT JOIN sp ON sp.session = den.session AND sp.block = den.block AND sp.w = den.w GROUP BY ALL)
    SELECT r.session, r.block, r.seq, CAST(coalesce(dc.density, 0) AS DOUBLE) AS density FROM readings r JOIN b ON b.session = r.session AND b.block = r.block
    LEFT JOIN dc ON dc.session = r.session AND dc.block = r.block AND dc.w = CAST(ceil((r.sn - lo) / 15000) AS BIGINT) AND dc.w > 1 WHERE r.param = 'SPO2'""",
)
def band_lookup(spark, sf):
    from ..operators import waveform as wf

    r = readings(spark, sf)
    blocks = r.where("param = 'PR'").groupBy("session", "block").agg(F.min("sn").alias("sn_start"), F.max("sn").alias("sn_stop"))
    spikes = r.where("param = 'HR'").select("session", "block", F.col("sn").alias("start_sn"))
    density = wf.spike_density(spikes, blocks)
    rows = r.where("param = 'SPO2'").select("session", "block", "seq", "sn")
    return wf.with_density(rows, density, blocks).select("session", "block", "seq", "density")


@query(
    "W19_spike_density",
    f"""WITH {READINGS}, b AS (SELECT session, block, min(sn) AS lo, max(sn) AS hi FROM readings WHERE param = 'PR' GROUP BY ALL),
    sp AS (SELECT r.session, r.block, CAST(ceil((sn - lo) / 15000) AS BIGINT) AS w FROM readings r JOIN b ON b.session = r.session AND b.block = r.block WHERE param = 'HR'),
    den AS (SELECT b.session, b.block, lo, w FROM b, LATERAL (SELECT unnest(range(1, CAST(ceil((hi - lo) / 15000) AS BIGINT))) AS w))
    SELECT den.session, den.block, den.w AS "window", lo + den.w * 15000 AS stop_sn, CAST(count(sp.w) / 30.0 AS DOUBLE) AS density FROM den
    LEFT JOIN sp ON sp.session = den.session AND sp.block = den.block AND sp.w = den.w GROUP BY ALL""",
)
def spike_density(spark, sf):
    from ..operators import waveform as wf

    r = readings(spark, sf)
    blocks = r.where("param = 'PR'").groupBy("session", "block").agg(F.min("sn").alias("sn_start"), F.max("sn").alias("sn_stop"))
    spikes = r.where("param = 'HR'").select("session", "block", F.col("sn").alias("start_sn"))
    return wf.spike_density(spikes, blocks)


