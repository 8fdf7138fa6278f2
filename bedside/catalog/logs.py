"""Log search over the events as device logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import log_search as ls
from ..plans.template_index import template_index
from ..session import literal_table
from . import query
from .base import READINGS, readings, table

TEMPLATES = [
    (1, "user ([0-9]*) did ([a-z]*)$"),
    (2, "value ([0-9.]*) over limit$"),
    (3, "alarm ([a-z]*) cleared$"),
    (4, "radio on$"),
    (5, "key ([0-9]*) of ([a-z]*) by ([0-9]*)$"),
]
LEVELS = [("debug", 0), ("info", 1), ("warn", 2)]
DEVICES = [("wrist", 0), ("chest", 1)]


def logs(spark, sf):
    e = table(spark, sf, "events")
    n = F.col("event_id")
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    content = (
        F.when(n % 5 == 0, F.array(user, kind))
        .when(n % 5 == 1, F.array(F.get_json_object("props", "$.k")))
        .when(n % 5 == 2, F.array(kind))
        .when(n % 5 == 3, F.array().cast("array<string>"))
        .otherwise(F.array(F.get_json_object("props", "$.k"), kind, user))
    )
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.concat(F.lit("site"), F.col("user_id") % 5).alias("site"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.floor(n / 1000).alias("lid"),
        F.col("user_id").alias("device_id"),
        n.alias("sq_num"),
        (n % 4).cast("int").alias("log_level"),
        (n % 3).cast("int").alias("device_type"),
        ts.alias("datetime_sent"),
        (n % 5 + 1).cast("int").alias("cipher_id"),
        content.alias("message_content"),
    )


LOGS = """logs AS (SELECT 'site' || user_id % 5 AS site, event_id // 1000 AS lid, user_id AS device_id, event_id AS sq_num, event_id % 4 AS lv, event_id % 3 AS dt, ts AS datetime_sent,
  event_id % 5 + 1 AS cipher_id, event_type, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k,
  CASE event_id % 5 WHEN 0 THEN 'user ' || user_id || ' did ' || event_type WHEN 1 THEN 'value ' || json_extract_string(props, '$.k') || ' over limit'
    WHEN 2 THEN 'alarm ' || event_type || ' cleared' WHEN 3 THEN 'radio on' ELSE 'key ' || json_extract_string(props, '$.k') || ' of ' || event_type || ' by ' || user_id END AS message,
  CASE event_id % 5 WHEN 0 THEN [CAST(user_id AS VARCHAR), event_type] WHEN 1 THEN [json_extract_string(props, '$.k')] WHEN 2 THEN [event_type]
    WHEN 3 THEN [] ELSE [json_extract_string(props, '$.k'), event_type, CAST(user_id AS VARCHAR)] END AS content,
  CASE event_id % 4 WHEN 0 THEN 'debug' WHEN 1 THEN 'info' WHEN 2 THEN 'warn' ELSE '3' END AS log_level,
  CASE event_id % 3 WHEN 0 THEN 'wrist' WHEN 1 THEN 'chest' ELSE '2' END AS device_type FROM events)"""


def _dimensions(spark):
    return (
        literal_table(spark, TEMPLATES, "id int, cipher string"),
        literal_table(spark, LEVELS, "cipher string, code int"),
        literal_table(spark, DEVICES, "cipher string, code int"),
    )


OUT = ["site", "device_id", "sq_num", "log_level", "device_type", "message"]
COLS = ", ".join(OUT)


@query("J16_dictionary_text", f"WITH {LOGS} SELECT {COLS} FROM logs")
def dictionary_text(spark, sf):
    return ls.readable(logs(spark, sf), *_dimensions(spark)).select(*OUT)


@query("L4_rebuilt_message", f"WITH {LOGS} SELECT sq_num, CAST(cipher_id AS INT) AS cipher_id, message FROM logs")
def rebuilt_message(spark, sf):
    return ls.readable(logs(spark, sf), *_dimensions(spark)).select("sq_num", "cipher_id", "message")


@query(
    "L1_log_search",
    f"""WITH {LOGS} SELECT {COLS} FROM logs WHERE datetime_sent BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00'
      AND site = 'site2' AND ((cipher_id = 3 AND event_type = 'error') OR cipher_id = 1 OR cipher_id = 4)""",
)
def log_search(spark, sf):
    out = ls.search(
        logs(spark, sf), *_dimensions(spark), start="2024-01-05 00:00:00", stop="2024-01-20 12:00:00",
        site="site2", message="alarm error cleared,user,radio on",
    )
    return out.select(*OUT)


@query(
    "L1_open_ended_search",
    f"""WITH {LOGS} SELECT {COLS} FROM logs WHERE datetime_sent > TIMESTAMP '2024-01-10 11:50:00' AND datetime_sent < TIMESTAMP '2024-01-10 12:10:00'""",
)
def open_ended_search(spark, sf):
    return ls.search(logs(spark, sf), *_dimensions(spark), start="2024-01-10 12:00", order_by="device_id").select(*OUT)


@query(
    "L2_wanted_templates",
    f"""WITH {LOGS} SELECT {COLS} FROM logs WHERE cipher_id = 4 OR (cipher_id = 3 AND event_type = 'view')
      OR (cipher_id = 5 AND k = '7' AND event_type = 'click') OR (cipher_id = 1 AND event_type = 'error')""",
)
def wanted_templates(spark, sf):
    """Templates with no, one and several contents; an empty content is free."""
    wanted = literal_table(
        spark, [(4, None), (3, ["view"]), (5, ["7", "click", ""]), (1, ["", "error"])], "id int, contents array<string>"
    )
    return ls.readable(ls.with_templates(logs(spark, sf), wanted), *_dimensions(spark)).select(*OUT)


@query(
    "L2_template_conditions",
    f"""WITH {LOGS} SELECT {COLS} FROM logs WHERE cipher_id NOT IN (2, 4, 6) AND NOT list_contains(content, '7') AND NOT list_contains(content, 'view')""",
)
def template_conditions(spark, sf):
    """Excluded: templates 2, 4 and 6 and any line with the content 7 or view."""
    keep = ls.template_filter([(2, ["7"]), (4, None), (6, ["view"])], False)
    return ls.readable(logs(spark, sf).where(keep), *_dimensions(spark)).select(*OUT)


@query(
    "L3_month_selection",
    f"WITH {LOGS} SELECT sq_num FROM logs WHERE datetime_sent >= TIMESTAMP '2023-11-15' AND datetime_sent <= TIMESTAMP '2024-01-12 06:00:00'",
)
def month_selection(spark, sf):
    first, last, _ = ls.time_range("2023-11-15", "2024-01-12 06:00:00")
    at = F.col("datetime_sent")
    return (
        logs(spark, sf).where(ls.months(first, last)).where(at.between(F.lit(first), F.lit(last))).select("sq_num")
    )


PART_TEMPLATE = "'part ' || p_name || ' ([0-9]*) of ([A-Z]*)$'"
TERMS = ["part hot bolt 12 of ABC", "large ring", "part blue ring 7 of"]


MATCHED = f"""WITH t AS (SELECT p_partkey AS id, {PART_TEMPLATE} AS cipher, unnest([{', '.join(f"'{x}'" for x in TERMS)}]) AS term FROM part),
    m AS (SELECT *, regexp_matches(term, '^' || cipher) AS plain, regexp_matches('^' || cipher, term) AS turned, regexp_matches(term || ' ', '^' || cipher) AS blank FROM t),
    s AS (SELECT *, CASE WHEN plain OR turned THEN term ELSE term || ' ' END AS subject FROM m WHERE plain OR turned OR blank)
    SELECT id, term, CASE WHEN regexp_matches(subject, '^' || cipher) THEN regexp_extract(subject, '^' || cipher, 1) || ',' || regexp_extract(subject, '^' || cipher, 2) END AS contents FROM s"""


def _part_templates(spark, sf):
    text = F.concat(F.lit("part "), "p_name", F.lit(" ([0-9]*) of ([A-Z]*)$"))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), text.alias("cipher"))


@query("J20_matching_templates", MATCHED)
def matching_templates(spark, sf):
    out = ls.matching_templates(_part_templates(spark, sf), TERMS)
    return out.select("id", "term", F.array_join("contents", ",").alias("contents"))


@query("J20_indexed_templates", MATCHED)
def indexed_templates(spark, sf):
    """The same templates, found through the index of their word pieces."""
    templates = _part_templates(spark, sf)
    out = ls.matching_templates(templates, TERMS, template_index(templates))
    return out.select("id", "term", F.array_join("contents", ",").alias("contents"))


@query(
    "C5_session_log_search",
    f"""WITH {LOGS}, {READINGS}, b AS (SELECT session, min(t) AS a, max(t) AS z FROM readings GROUP BY session)
    SELECT b.session, {COLS} FROM logs JOIN b ON b.session = device_id AND epoch_us(datetime_sent) / 1000000.0 BETWEEN a AND z WHERE cipher_id <> 2 AND cipher_id <> 4""",
)
def session_log_search(spark, sf):
    """The lines of every session's device while it was on it, without two templates."""
    blocks = readings(spark, sf).groupBy("session", "block").agg(F.min("t").alias("unix_start"), F.max("t").alias("unix_stop"))
    blocks = blocks.withColumn("device_id", F.col("session"))
    out = ls.search(
        logs(spark, sf), *_dimensions(spark), blocks=blocks, without="value,radio on", order_by="sq_num"
    )
    return out.select("session", *OUT)
