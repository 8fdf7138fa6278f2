"""How the driver tables stand in for sessions, readings and the rest.

Each binding is a DataFrame function and the SQL of the same rows.  State
codes and resets are derived by a rule, so both engines see the same edge cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START = 1704067200  # first second of the events
WEEK = 604800
DAY = 86400
RATE = 86400.0  # binding: readings are expected once a day

PARAMS = {"view": "PR", "click": "HR", "purchase": "SPO2", "signup": "TIME_SYNC", "error": "RR"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(ts: Column) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / 1_000_000)


def when_map(column: Column, mapping: dict) -> Column:
    out = F.lit(None)
    for k, v in mapping.items():
        out = F.when(column == k, F.lit(v)).otherwise(out)
    return out


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    s = seconds(F.col("ts"))
    n = F.col("event_id")
    value = (
        F.when(n % 11 == 0, -1.0)
        .when(n % 17 == 0, -2.0)
        .when(n % 37 == 0, -4.0)
        .when(n % 41 == 0, -5.0)
        .when(n % 43 == 0, -10.0)
        .otherwise(F.col("value"))
    )
    return e.select(
        F.col("user_id").alias("session"),
        F.floor((s - START) / WEEK).alias("block"),
        when_map(F.col("event_type"), PARAMS).alias("param"),
        n.alias("seq"),
        ((s - START) % WEEK).alias("sn"),
        s.cast("double").alias("t"),
        value.alias("value"),
    )


READINGS = f"""readings AS (
  SELECT user_id AS session, (epoch_us(ts)//1000000 - {START})//{WEEK} AS block,
    CASE event_type WHEN 'view' THEN 'PR' WHEN 'click' THEN 'HR' WHEN 'purchase' THEN 'SPO2'
      WHEN 'signup' THEN 'TIME_SYNC' WHEN 'error' THEN 'RR' END AS param,
    event_id AS seq, (epoch_us(ts)//1000000 - {START}) % {WEEK} AS sn,
    CAST(epoch_us(ts)//1000000 AS DOUBLE) AS t,
    CAST(CASE WHEN event_id % 11 = 0 THEN -1 WHEN event_id % 17 = 0 THEN -2
      WHEN event_id % 37 = 0 THEN -4 WHEN event_id % 41 = 0 THEN -5
      WHEN event_id % 43 = 0 THEN -10 ELSE value END AS DOUBLE) AS value
  FROM events)"""

MARKS = READINGS + f""", stepped AS (
  SELECT *, lag(t) OVER w AS pt, lag(sn) OVER w AS psn, lag(value) OVER w AS pv,
    lead(t) OVER w AS nt, lead(sn) OVER w AS nsn
  FROM readings WINDOW w AS (PARTITION BY session, param ORDER BY t, seq)),
 marked AS (
  SELECT *, coalesce(sn < psn, false) AS reset,
    CASE WHEN nsn >= sn THEN nt END AS next_t,
    coalesce(nsn >= sn AND nt - t > {RATE} + 0.1, false) AS gap,
    coalesce(sn >= psn AND t - pt > {RATE} + 0.1, false) AS prev_gap,
    value < 0 AND value > -4 AS flagged,
    coalesce(sn >= psn AND pv < 0 AND pv > -4, false) AS prev_flagged
  FROM stepped),
 numbered AS (
  SELECT *, sum(CASE WHEN reset THEN 1 ELSE 0 END) OVER w AS epoch,
    CASE WHEN gap THEN sum(CASE WHEN gap AND NOT prev_gap THEN 1 ELSE 0 END) OVER w END AS gap_id,
    CASE WHEN flagged THEN sum(CASE WHEN flagged AND NOT prev_flagged THEN 1 ELSE 0 END) OVER w END AS run_id
  FROM marked WINDOW w AS (PARTITION BY session, param ORDER BY t, seq ROWS UNBOUNDED PRECEDING))"""

DROPOUTS = MARKS + f""", dropouts AS (
  SELECT session, param, epoch, gap_id, min(t) + {RATE} AS start, max(next_t) AS stop,
    CASE WHEN count(*) = count(run_id) AND min(run_id) = max(run_id) THEN min(run_id) END AS inside_run
  FROM numbered WHERE gap GROUP BY ALL),
 runs AS (
  SELECT r.*, coalesce(d.dropout, 0) AS dropout FROM (
    SELECT session, param, epoch, run_id, min(t) AS start, max(coalesce(next_t, t)) AS stop
    FROM numbered WHERE flagged GROUP BY ALL HAVING count(*) > 1 OR count(next_t) > 0) r
  LEFT JOIN (SELECT session, param, epoch, inside_run, sum(stop - start) AS dropout
    FROM dropouts WHERE inside_run IS NOT NULL GROUP BY ALL) d
  ON r.session = d.session AND r.param = d.param AND r.epoch = d.epoch AND r.run_id = d.inside_run)"""


def cuff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cuff readings: 'SPO2' rows read as sys, with dia and map derived."""
    return _pressure(readings(spark, sf_dir).where("param = 'SPO2'")).select(
        "session", "sn", "t", "seq", "sys", "dia", "map",
        (F.col("seq") % 97).cast("double").alias("pr"), (F.col("seq") % 3).alias("error_code"),
    )


def continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pressure(readings(spark, sf_dir).where("param = 'PR'")).select(
        "session", "sn", "t", "seq", "sys", "dia", "map"
    )


def _pressure(df: DataFrame) -> DataFrame:
    v = F.col("value")
    return (
        df.withColumn("sys", v)
        .withColumn("dia", F.when(v > 0, F.floor(v / 2).cast("double")).otherwise(v))
        .withColumn("map", F.when(v > 0, F.floor(v * 2 / 3).cast("double")).otherwise(v))
    )


def _pressure_sql(name: str, param: str, extra: str = "") -> str:
    return f"""{name} AS (
  SELECT session, sn, t, seq, value AS sys,
    CASE WHEN value > 0 THEN floor(value / 2) ELSE value END AS dia,
    CASE WHEN value > 0 THEN floor(value * 2 / 3) ELSE value END AS map{extra}
  FROM readings WHERE param = '{param}')"""


PRESSURES = ", ".join(
    [
        READINGS,
        _pressure_sql("bp", "SPO2", ", CAST(seq % 97 AS DOUBLE) AS pr, seq % 3 AS error_code"),
        _pressure_sql("cnibp", "PR"),
    ]
)


def device_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarm rows: props key as code, a third of the rows share a start."""
    e = table(spark, sf_dir, "events").where("event_type in ('error', 'signup')")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(
        F.col("user_id").alias("session"),
        F.col("event_id").alias("seq"),
        seconds(F.col("ts")).cast("double").alias("t"),
        (k % 40).alias("code"),
        (k % 4).alias("severity"),
        (F.col("event_id") % 2).alias("state"),
        F.floor(F.col("event_id") / 3000).alias("start_sn"),
    )


ALARMS = """alarms AS (
  SELECT user_id AS session, event_id AS seq, CAST(epoch_us(ts)//1000000 AS DOUBLE) AS t,
    CAST(json_extract(props, '$.k') AS BIGINT) % 40 AS code,
    CAST(json_extract(props, '$.k') AS BIGINT) % 4 AS severity,
    event_id % 2 AS state, event_id // 3000 AS start_sn
  FROM events WHERE event_type IN ('error', 'signup'))"""


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session facts: an order is a session, its nation the site, its segment the unit."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    duration = F.floor("o_totalprice")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("session"),
            F.col("n_name").alias("site"),
            F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("care_unit"),
            F.col("o_orderdate").cast("date").alias("date_stop"),
            duration.alias("duration"),
            duration.alias("time_wt"),
            F.when(F.col("o_orderkey") % 7 == 0, 0).otherwise(F.floor(duration / 2)).alias("time_cable"),
            duration.alias("time_total"),
            F.floor(duration / 3).alias("time_cnibp"),
        )
    )


SESSIONS = """sessions AS (
  SELECT o_orderkey AS session, n_name AS site,
    CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS care_unit,
    CAST(o_orderdate AS DATE) AS date_stop, CAST(floor(o_totalprice) AS BIGINT) AS duration,
    CAST(floor(o_totalprice) AS BIGINT) AS time_wt,
    CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) // 2 END AS time_cable,
    CAST(floor(o_totalprice) AS BIGINT) AS time_total,
    CAST(floor(o_totalprice) AS BIGINT) // 3 AS time_cnibp
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

SWEPT = {1: ("SPO2", "LOW"), 2: ("HR", "HIGH"), 3: ("PR", "LOW"), 4: ("RR", "HIGH"),
         5: ("CNIBP_SYS", "HIGH"), 6: ("CNIBP_DIA", "LOW"), 7: ("HR_A", "HIGH")}


def swept_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    return li.select(
        F.col("l_orderkey").alias("session"),
        when_map(n, {k: v[0] for k, v in SWEPT.items()}).alias("param"),
        when_map(n, {k: v[1] for k, v in SWEPT.items()}).alias("kind"),
        (F.col("l_quantity") % 5).cast("int").alias("limit"),
        (F.col("l_suppkey") % 3 * 5).cast("int").alias("delay"),
        (F.col("l_partkey") % 9 + 1).alias("alarms"),
    )


def site_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    pairs = F.array(
        *[F.struct(F.lit(p).alias("param"), F.lit(k).alias("kind")) for p, k in SWEPT.values() if p != "HR_A"]
    )
    return nation.select(
        F.col("n_name").alias("site"),
        F.explode(pairs).alias("p"),
        (F.col("n_nationkey") % 5).alias("limit"),
        (F.col("n_nationkey") % 3 * 5).alias("delay"),
    ).select("site", "p.param", "p.kind", "limit", "delay")


SWEPT_SQL = (
    "swept AS (SELECT l_orderkey AS session, CASE l_linenumber "
    + " ".join(f"WHEN {k} THEN '{v[0]}'" for k, v in SWEPT.items())
    + " END AS param, CASE l_linenumber "
    + " ".join(f"WHEN {k} THEN '{v[1]}'" for k, v in SWEPT.items())
    + " END AS kind, CAST(l_quantity % 5 AS INT) AS lim, CAST(l_suppkey % 3 * 5 AS INT) AS delay, "
    "l_partkey % 9 + 1 AS alarms FROM lineitem), defaults AS (SELECT n_name AS site, param, kind, "
    "n_nationkey % 5 AS lim, n_nationkey % 3 * 5 AS delay FROM nation, (VALUES "
    + ", ".join(f"('{p}', '{k}')" for p, k in SWEPT.values())
    + ") v(param, kind))"
)


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals: a line item lasts its quantity in days from its ship date, per supplier."""
    li = table(spark, sf_dir, "lineitem")
    first = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint")
    return li.select(
        F.col("l_suppkey").alias("session"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_returnflag").alias("tag"),
        first.alias("begin"),
        (first + F.col("l_quantity").cast("bigint")).alias("end"),
    )


SPANS = """spans AS (
  SELECT l_suppkey AS session, l_orderkey AS order_id, l_linenumber AS line, l_returnflag AS tag,
    CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS "begin",
    CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) + CAST(l_quantity AS BIGINT) AS "end"
  FROM lineitem)"""


def merged_sql(source: str, name: str, keys: str, strict: bool = True) -> str:
    """SQL of the interval union of ``source`` (keys, begin, end)."""
    op = ">=" if strict else ">"
    return f"""{name} AS (
  SELECT {keys}, min("begin") AS "begin", max("end") AS "end", sum(n) AS merged FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY "begin" ROWS UNBOUNDED PRECEDING) AS grp FROM (
      SELECT *, CASE WHEN coalesce("begin" {op} max("end") OVER (PARTITION BY {keys} ORDER BY "begin"
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN 1 ELSE 0 END AS fresh
      FROM (SELECT {keys}, "begin", max("end") AS "end", count(*) AS n FROM {source} GROUP BY {keys}, "begin")))
  GROUP BY {keys}, grp)"""
