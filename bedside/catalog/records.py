"""Stored tables, packets, annotations and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clock, codes, device, text
from ..model import SCALES
from ..plans import ingest
from ..sources import annotations as notes
from ..sources import packets as pk
from ..sources import tables as stored
from ..session import literal_table, shared_folder
from . import query
from .base import (
    ALARMS,
    PRESSURES,
    READINGS,
    cuff,
    device_alarms,
    readings,
    sessions,
    table,
)
from .base import SESSIONS as SESSIONS_SQL

# ---- sources and sinks ---------------------------------------------------------


@query(
    "S1_chosen_series",
    f"WITH {READINGS} SELECT session, block, param, sn, t, value FROM readings WHERE param IN ('PR', 'SPO2', 'TIME_SYNC')",
)
def chosen_series(spark, sf):
    r = stored.select_readings(readings(spark, sf), params=["PR", "SPO2"])
    return r.select("session", "block", "param", "sn", "t", "value")


@query(
    "S2_merged_blocks",
    f"""WITH {READINGS}, w AS (SELECT *, seq % 3 AS width FROM readings),
    k AS (SELECT w.* FROM w WHERE EXISTS (SELECT 1 FROM readings r WHERE r.session = w.session AND r.block = w.block AND r.param = 'TIME_SYNC'))
    SELECT session, block, CASE WHEN param = 'SPO2' AND width > 1 THEN 'SPO2_V2' ELSE param END AS param, sn, value FROM k""",
)
def merged_blocks(spark, sf):
    r = readings(spark, sf).withColumn("width", F.col("seq") % 3)
    return stored.merge_blocks(r, "SPO2").select("session", "block", "param", "sn", "value")


@query(
    "S3_storage_layout",
    f"""WITH {READINGS} SELECT 'tier2' AS tier, param, count(*) AS n FROM readings GROUP BY param
    UNION ALL SELECT 'tier1', 'ECG', count(*) FROM embeddings""",
)
def storage_layout(spark, sf):
    r = readings(spark, sf).select("session", "param")
    waves = table(spark, sf, "embeddings").select(F.col("vec_id").alias("session"), F.lit("ECG").alias("param"))
    return stored.with_layout(r.unionByName(waves)).groupBy("tier", "param").agg(F.count(F.lit(1)).alias("n"))


@query(
    "S4_block_metadata",
    f"""WITH {READINGS} SELECT session, block, min(t) AS t0, max(t) AS t1, string_agg(DISTINCT param, ',' ORDER BY param) AS params FROM readings GROUP BY ALL""",
)
def block_metadata(spark, sf):
    return ingest.block_spans(readings(spark, sf)).withColumn("params", F.array_join("params", ","))


@query(
    "S5_metadata_merge",
    f"""WITH {READINGS}, p AS (SELECT session, block, seq, param, seq % 13 AS dev, seq % 100 AS c, CASE WHEN seq % 2 = 0 THEN t END AS t0, t AS t1 FROM readings),
    arr AS (SELECT session, block, string_agg(param || '=' || v, ',' ORDER BY param) AS arrays FROM (SELECT session, block, param, arg_max(seq, seq) AS v FROM p GROUP BY ALL) GROUP BY ALL),
    con AS (SELECT session, block, string_agg('K' || k || '=' || v, ',' ORDER BY k) AS constants FROM (SELECT session, block, seq % 3 AS k, arg_max(c, seq) AS v FROM p GROUP BY ALL) GROUP BY ALL),
    dv AS (SELECT session, block, string_agg(dev::VARCHAR, ',' ORDER BY dev) AS devices FROM (SELECT DISTINCT session, block, dev FROM p) GROUP BY ALL),
    ts AS (SELECT session, block, arg_max(t0, seq) FILTER (WHERE t0 IS NOT NULL) AS t0, arg_max(t1, seq) AS t1 FROM p GROUP BY ALL)
    SELECT ts.session, ts.block, ts.t0, ts.t1, arrays, constants, devices FROM ts JOIN arr ON arr.session = ts.session AND arr.block = ts.block
    JOIN con ON con.session = ts.session AND con.block = ts.block JOIN dv ON dv.session = ts.session AND dv.block = ts.block""",
)
def metadata_merge(spark, sf):
    r = readings(spark, sf)
    partials = r.select(
        "session",
        "block",
        "seq",
        F.create_map("param", F.col("seq").cast("string")).alias("arrays"),
        F.array(F.col("seq") % 13).alias("devices"),
        F.create_map(F.concat(F.lit("K"), F.col("seq") % 3), (F.col("seq") % 100).cast("int")).alias("constants"),
        F.when(F.col("seq") % 2 == 0, F.col("t")).alias("t0"),
        F.col("t").alias("t1"),
    )
    out = stored.merged_metadata(partials)

    def flat(column):
        entries = F.array_sort(F.map_entries(column))
        return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")

    return out.select(
        "session", "block", "t0", "t1", flat("arrays").alias("arrays"), flat("constants").alias("constants"),
        F.array_join(F.col("devices").cast("array<string>"), ",").alias("devices"),
    )


@query(
    "S6_metadata_worklist",
    """WITH files AS (SELECT l_suppkey AS session, l_linenumber AS block, 'tier2/' || l_suppkey || '/' || l_linenumber || '/meta-' || l_orderkey AS key, 'meta-' || l_orderkey AS name FROM lineitem),
    jobs AS (SELECT unnest(['meta-' || o_orderkey, 'log-' || o_orderkey]) AS name FROM orders WHERE o_orderstatus = 'F'),
    ex AS (SELECT s_suppkey AS session, 1 AS block, 'meta' || s_suppkey AS meta FROM supplier)
    SELECT f.session, f.block, min(key) AS first_key, count(DISTINCT key) AS partials, any_value(meta) AS meta FROM files f
    JOIN (SELECT DISTINCT name FROM jobs WHERE name LIKE '%meta%') j ON j.name = f.name LEFT JOIN ex ON ex.session = f.session AND ex.block = f.block GROUP BY f.session, f.block""",
)
def metadata_worklist(spark, sf):
    li = table(spark, sf, "lineitem")
    name = F.concat(F.lit("meta-"), "l_orderkey")
    files = li.select(
        F.col("l_suppkey").alias("session"),
        F.col("l_linenumber").alias("block"),
        F.concat_ws("/", F.lit("tier2"), F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string"), name).alias("key"),
    )
    jobs = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.to_json(F.array(F.concat(F.lit("meta-"), "o_orderkey"), F.concat(F.lit("log-"), "o_orderkey"))).alias("names")
    )
    existing = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("session"), F.lit(1).alias("block"), F.concat(F.lit("meta"), "s_suppkey").alias("key")
    )
    out = stored.metadata_worklist(jobs, files, existing)
    return out.withColumn("partials", F.size("partials").cast("bigint"))


@query(
    "S7_lookups",
    f"WITH {SESSIONS_SQL} SELECT session, site, duration FROM sessions WHERE site = 'NATION_7' AND care_unit IS NULL",
)
def lookups(spark, sf):
    return stored.lookup(
        sessions(spark, sf), ["session", "site", "duration"], site="NATION_7", care_unit=None
    )


LINE = """'deviceID=' || (100000 + user_id) || ' x Date=' || strftime(ts, '%d %b %Y %H:%M:%S') || chr(9) || ' ' || event_type || '  ' || chr(9) || props"""


@query(
    "S8_log_text",
    """SELECT 100000 + user_id AS device_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type AS field, props AS rest FROM events WHERE event_id % 9 <> 0 AND event_id % 10 <> 0""",
)
def log_text(spark, sf):
    """Lines are written out first; a ninth lack the date, a tenth the tabs."""
    from ..sources.logs_text import parsed_lines

    return _log_columns(parsed_lines(_log_lines(spark, sf)))


def _log_lines(spark, sf):
    e = table(spark, sf, "events")
    n = F.col("event_id")
    stamp = F.date_format("ts", "dd MMM yyyy HH:mm:ss")
    head = F.concat(
        F.lit("deviceID="), (F.col("user_id") + 100000).cast("string"), F.when(n % 9 == 0, F.lit(" x ")).otherwise(F.concat(F.lit(" x Date="), stamp))
    )
    body = F.concat(F.lit("\t "), F.col("event_type"), F.lit("  \t"), F.col("props"))
    return e.select(F.concat(head, F.when(n % 10 == 0, F.lit("")).otherwise(body)).alias("value"))


def _log_columns(lines):
    return lines.select(
        "device_id",
        F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"),
        F.get("fields", 0).alias("field"),
        F.get("fields", 1).alias("rest"),
    )


@query(
    "S8_log_files",
    """SELECT 100000 + user_id AS device_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type AS field, props AS rest FROM events
    WHERE event_id % 9 <> 0 AND event_id % 10 <> 0 AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND user_id >= 3""",
)
def log_files(spark, sf):
    """The lines go to gzip files; the device and date filters are pushed into the data source."""
    import uuid

    from ..sources.log_files import read_log_files

    folder = f"{shared_folder(spark)}/device-logs-{uuid.uuid4().hex}"
    _log_lines(spark, sf).write.text(folder, compression="gzip")
    rows = read_log_files(spark, folder)
    wanted = rows.where((F.col("device_id") >= 100003) & (F.col("at") >= F.lit("2024-01-05 00:00:00").cast("timestamp")))
    return _log_columns(wanted)


def _packets(spark, sf):
    """Binding: a reading is a packet; its type is the place of its param."""
    r = readings(spark, sf)
    kind = F.array_position(F.array(*[F.lit(p) for p in ("TIME_SYNC", "PR", "HR", "SPO2", "RR")]), F.col("param"))
    return r.select(
        "session", "block", kind.alias("id"), "seq", "sn", (F.col("t") * 1000).cast("bigint").alias("tm"),
        F.col("session").alias("device"), F.col("block").alias("segment"), (F.col("seq") % 300 + 100).alias("size"), "value",
    )


PACKETS = READINGS + """, packets AS (SELECT session, block, list_position(['TIME_SYNC', 'PR', 'HR', 'SPO2', 'RR'], param) AS id, seq, sn,
  CAST(t * 1000 AS BIGINT) AS tm, session AS device, block AS segment, seq % 300 + 100 AS size, value FROM readings)"""


@query(
    "S9_packet_selection",
    f"WITH {PACKETS} SELECT session, sn, tm FROM packets WHERE tm BETWEEN 1704500000000 AND 1706000000000 AND id IN (1, 3)",
)
def packet_selection(spark, sf):
    p = _packets(spark, sf)
    return (
        p.where(F.col("tm").between(1704500000000, 1706000000000) & F.col("id").isin(1, 3))
        .select("session", "sn", "tm")
        .orderBy("tm", "sn")
    )


@query(
    "S10_replaced_sessions",
    """WITH old AS (SELECT o_custkey AS session, o_orderkey AS row_id, o_totalprice AS v FROM orders), ses AS (SELECT c_custkey AS session FROM customer WHERE c_acctbal < 2000)
    SELECT * FROM old WHERE session NOT IN (SELECT session FROM ses) UNION ALL
    SELECT o_custkey, -o_orderkey, o_totalprice * 2 FROM orders WHERE o_orderstatus = 'F' AND o_custkey IN (SELECT session FROM ses)""",
)
def replaced_sessions(spark, sf):
    """A result table after sessions of some customers were mined again."""
    from ..sources.sinks import replaced

    o = table(spark, sf, "orders")
    old = o.select(F.col("o_custkey").alias("session"), F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("v"))
    again = table(spark, sf, "customer").where("c_acctbal < 2000").select(F.col("c_custkey").alias("session"))
    fresh = o.where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("session"), (-F.col("o_orderkey")).alias("row_id"), (F.col("o_totalprice") * 2).alias("v")
    )
    return replaced(old, fresh.join(again, "session", "left_semi"), again)


@query(
    "S12_csv_columns",
    f"""WITH {READINGS} SELECT session, block, min(t) AS t0, max(t) AS t1, string_agg(DISTINCT param, ' ' ORDER BY param) AS params FROM readings GROUP BY ALL""",
)
def csv_columns(spark, sf):
    from ..sources.sinks import flat

    return flat(ingest.block_spans(readings(spark, sf)))


@query(
    "S13_logs_into_session",
    f"""WITH {PACKETS}, sy AS (SELECT segment, sn, min(tm) AS tm FROM packets WHERE id = 1 GROUP BY ALL),
    g AS (SELECT segment, sn, tm, lead(sn) OVER w AS sn1, lead(tm) OVER w AS tm1 FROM sy WINDOW w AS (PARTITION BY segment ORDER BY sn)),
    r AS (SELECT DISTINCT id, sn AS own, tm, seq AS raw FROM packets WHERE id = 3)
    SELECT CAST(id AS BIGINT) AS id, r.tm, raw, min(segment) AS segment, CAST(trunc(arg_min(g.sn + (r.tm - g.tm) * (sn1 - g.sn) / (tm1 - g.tm), segment)) AS BIGINT) AS sn
    FROM r JOIN g ON r.tm >= g.tm AND r.tm < tm1 WHERE sn1 IS NOT NULL AND tm1 > g.tm GROUP BY id, own, r.tm, raw""",
)
def logs_into_session(spark, sf):
    p = _packets(spark, sf)
    syncs = p.where("id = 1").groupBy("segment", "sn").agg(F.min("tm").alias("tm"))
    logs = p.where("id = 3").select("id", "sn", "tm", F.lit(1).alias("device"), F.col("seq").alias("raw"))
    out = pk.logs_into_session(logs, 1, 0, 4_000_000_000_000, syncs)
    return out.select("id", "tm", "raw", "segment", "sn")


@query(
    "S14_chunk_manifest",
    f"""WITH RECURSIVE {PACKETS}, n AS (SELECT session, sn, tm, size, row_number() OVER w AS k,
      coalesce(last_value(CASE WHEN sn IS NOT NULL THEN segment END IGNORE NULLS) OVER w, first_value(CASE WHEN sn IS NOT NULL THEN segment END IGNORE NULLS) OVER (PARTITION BY session ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), -1) AS segment
      FROM packets WINDOW w AS (PARTITION BY session ORDER BY seq ROWS UNBOUNDED PRECEDING)),
    c AS (SELECT session, k, segment, size AS filled, CAST(0 AS BIGINT) AS num FROM n WHERE k = 1 UNION ALL
      SELECT n.session, n.k, n.segment, CASE WHEN filled >= 1200 OR n.segment <> c.segment THEN n.size ELSE filled + n.size END,
        num + CASE WHEN filled >= 1200 THEN 1 ELSE 0 END + CASE WHEN n.segment <> c.segment THEN 1 ELSE 0 END FROM c JOIN n ON n.session = c.session AND n.k = c.k + 1)
    SELECT session, num, CAST(sum(size) AS BIGINT) AS size, min(n.segment) AS segment, min(tm) AS min_ts, max(tm) AS max_ts, min(sn) AS min_sn, max(sn) AS max_sn
    FROM c JOIN n USING (session, k) GROUP BY session, num""",
)
def chunk_manifest(spark, sf):
    return pk.chunk_manifest(_packets(spark, sf), limit=1200)


ANN = """versions AS (SELECT o_custkey AS id, o_orderkey AS version, o_totalprice AS start_time, o_orderpriority AS notes, o_orderkey % 5 = 0 AS deleted FROM orders)"""


@query(
    "S15_current_annotations",
    f"""WITH {ANN} SELECT id, version, start_time, notes FROM versions QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1 AND NOT deleted""",
)
def current_annotations(spark, sf):
    o = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("version"), F.col("o_totalprice").alias("start_time"),
        F.col("o_orderpriority").alias("notes"), (F.col("o_orderkey") % 5 == 0).alias("deleted"),
    )
    return notes.current_view(o).drop("deleted")


# ---- scalar functions ------------------------------------------------------------


@query(
    "P1_recoded",
    """SELECT l_orderkey, l_linenumber, CAST(CASE WHEN v BETWEEN 16374 AND 16383 THEN v - 16384 ELSE v END AS DOUBLE) AS value
    FROM (SELECT l_orderkey, l_linenumber, 16370.0::DOUBLE + l_partkey % 20 AS v FROM lineitem)""",
)
def recoded(spark, sf):
    li = table(spark, sf, "lineitem")
    v = (F.lit(16370.0) + F.col("l_partkey") % 20).alias("value")
    return li.select("l_orderkey", "l_linenumber", codes.recode(v).alias("value"))


KINDS = list(SCALES)


@query(
    "P2_units",
    f"""WITH {READINGS}, k AS (SELECT *, [{', '.join(f"'{k}'" for k in [*KINDS, 'PR'])}][seq % {len(KINDS) + 1} + 1] AS kind FROM readings)
    SELECT session, seq, kind, t - min(t) OVER (PARTITION BY session) AS t, value * CASE kind {' '.join(f"WHEN '{k}' THEN CAST({v!r} AS DOUBLE)" for k, v in SCALES.items())} ELSE 1 END AS value FROM k""",
)
def units(spark, sf):
    names = F.array(*[F.lit(k) for k in [*KINDS, "PR"]])
    r = readings(spark, sf).withColumn("kind", F.get(names, (F.col("seq") % (len(KINDS) + 1)).cast("int")))
    out = codes.zeroed(codes.to_units(r), ["session"])
    return out.select("session", "seq", "kind", "t", "value")


@query(
    "P3_low_bits_dropped",
    "SELECT l_orderkey, l_linenumber, (l_partkey * 977 - 900000) >> 8 AS sample FROM lineitem WHERE l_partkey * 977 - 900000 >= 0 UNION ALL "
    "SELECT l_orderkey, l_linenumber, CAST(floor((l_partkey * 977 - 900000) / 256) AS BIGINT) FROM lineitem WHERE l_partkey * 977 - 900000 < 0",
)
def low_bits_dropped(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", codes.without_low_bits(F.col("l_partkey") * 977 - 900000).alias("sample")
    )


@query(
    "P4_source_precedence",
    f"""WITH {READINGS}, c AS (SELECT session, block, seq, value, CASE param WHEN 'PR' THEN 'RHYTHM' WHEN 'HR' THEN 'SCI' END AS source FROM readings WHERE param IN ('PR', 'HR')),
    b AS (SELECT session, block, bool_or(source = 'RHYTHM') AS r FROM c GROUP BY ALL)
    SELECT c.session, c.block, c.seq, c.source, c.value FROM c JOIN b ON b.session = c.session AND b.block = c.block WHERE c.source = 'RHYTHM' OR NOT r""",
)
def source_precedence(spark, sf):
    r = readings(spark, sf).where("param in ('PR', 'HR')")
    r = r.withColumn("source", F.when(F.col("param") == "PR", "RHYTHM").otherwise("SCI"))
    out = codes.by_precedence(r, ["RHYTHM", "SCI"], ["session", "block"])
    return out.select("session", "block", "seq", "source", "value")


@query(
    "P5_sequence_filter",
    f"""WITH {READINGS} SELECT session, block, param, seq, sn FROM readings WHERE param = 'RR'
      OR (sn >= CASE WHEN block = 0 THEN 0 ELSE 50000 END AND sn <= 500000 AND sn > 0)""",
)
def sequence_filter(spark, sf):
    keep = codes.in_sequence(
        F.col("sn"), F.lit(50000), F.lit(500000), F.col("param") == "RR", F.col("block") == 0
    )
    return readings(spark, sf).where(keep).select("session", "block", "param", "seq", "sn")


@query(
    "P6_joined_code_text",
    f"""WITH {ALARMS} SELECT session, start_sn, string_agg(DISTINCT 'alarm ' || code, ' ' ORDER BY 'alarm ' || code) AS text FROM alarms WHERE code < 35 GROUP BY ALL""",
)
def joined_code_text(spark, sf):
    dimension = literal_table(spark, [(i, f"alarm {i}") for i in range(40)], "code bigint, text string")
    a = device_alarms(spark, sf).withColumn("code", F.when(F.col("code") >= 35, 999).otherwise(F.col("code")))
    return codes.joined_text(a, dimension, ["session", "start_sn"])


@query(
    "P6_decoded",
    f"""WITH {ALARMS} SELECT session, seq, code, CASE WHEN code < 30 THEN 'alarm ' || code END AS text FROM alarms""",
)
def decoded(spark, sf):
    dimension = literal_table(spark, [(i, f"alarm {i}") for i in range(30)], "code bigint, text string")
    return codes.decoded(device_alarms(spark, sf), dimension).select("session", "seq", "code", "text")


_ID = "(p_partkey % 16384) + ((p_size % 16) << 14) + ((p_partkey % 40) << 18)"


@query(
    "P7_serial_numbers",
    f"""SELECT p_partkey, '????20' || lpad(CAST(((({_ID}) >> 18) & 63) + 13 AS VARCHAR), 2, '0') || lpad(CAST((({_ID}) >> 14) & 15 AS VARCHAR), 2, '0')
      || lpad(CAST(({_ID}) & 16383 AS VARCHAR), 5, '0') AS serial_no, CAST({_ID} AS BIGINT) AS device_id,
      CAST(CASE WHEN p_partkey % 40 < 16 THEN -1 ELSE (p_partkey % 16384) + ((p_size % 16) << 14) + ((p_partkey % 40 - 13) << 18) END AS BIGINT) AS odd_id
    FROM part""",
)
def serial_numbers(spark, sf):
    """Ids to serial numbers and back; odd texts have a bad year or a letter."""
    p = table(spark, sf, "part")
    k, size = F.col("p_partkey"), F.col("p_size").cast("bigint")
    ident = (k % 16384).bitwiseOR(F.shiftleft(size % 16, 14)).bitwiseOR(F.shiftleft(k % 40, 18))
    p = p.withColumn("_sn", device.serial_number(ident))
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    odd = F.concat(
        F.when(k % 40 < 13, pad(k % 40, 2)).when(k % 40 < 16, F.lit("2x")).otherwise(pad(k % 40, 2)), pad(size % 16, 2), pad(k % 16384, 5)
    )
    return p.select(
        "p_partkey", F.col("_sn").alias("serial_no"), device.device_id(F.col("_sn")).alias("device_id"), device.device_id(odd).alias("odd_id")
    )


@query(
    "P8_local_time",
    f"""WITH {READINGS} SELECT seq, strftime(timezone('America/Los_Angeles', to_timestamp(t)), '%Y-%m-%d %H:%M:%S') AS local_text,
      CAST((dayofweek(timezone('America/Los_Angeles', to_timestamp(t))) + 6) % 7 AS BIGINT) AS weekday, t AS back FROM readings""",
)
def local_time(spark, sf):
    r = readings(spark, sf)
    zone = "America/Los_Angeles"
    out = r.withColumn("local_text", clock.local_text(F.col("t"), zone))
    return out.select(
        "seq",
        "local_text",
        clock.weekday(clock.local_time(F.col("t"), zone)).cast("bigint").alias("weekday"),
        clock.unix_time(F.col("local_text"), zone).alias("back"),
    )


@query(
    "P9_analytics_text",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'step ' || event_id || ' of ' || user_id WHEN 1 THEN 'user ' || lpad(CAST(event_id AS VARCHAR), 9, '0') || '/' || user_id END AS message FROM events""",
)
def analytics_text(spark, sf):
    e = table(spark, sf, "events").withColumn("subtype", F.col("event_id") % 3)
    formats = {0: "step %d of %d", 1: "user %09d/%d"}
    return text.analytics_text(e, formats, "subtype", ["event_id", "user_id"]).select("event_id", "message")


@query(
    "P10_packed_ids",
    "SELECT o_orderkey, o_orderkey * 7 >> 8 AS device, o_orderkey * 7 & 255 AS segment FROM orders",
)
def packed_ids(spark, sf):
    o = table(spark, sf, "orders").withColumn("packed", F.col("o_orderkey") * 7)
    return ingest.unpacked(o).select("o_orderkey", "device", "segment")


@query(
    "P11_rail_clipping",
    """SELECT l_orderkey, l_linenumber, CASE WHEN v >= 8388576 OR v <= -8388576 THEN 8388576 ELSE v END AS sample,
      CAST(CASE WHEN l_partkey % 7 = 0 THEN 4194303 ELSE l_quantity END AS DOUBLE) AS ppg
    FROM (SELECT *, (l_partkey - 1000) * 9001 AS v FROM lineitem)""",
)
def rail_clipping(spark, sf):
    from ..operators.waveform import clipped

    li = table(spark, sf, "lineitem")
    v = (F.col("l_partkey") - 1000) * 9001
    ppg = F.when(F.col("l_partkey") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    return li.select(
        "l_orderkey", "l_linenumber", clipped(v).cast("bigint").alias("sample"), codes.saturated(ppg, 4194303).alias("ppg")
    )


@query(
    "P12_cuff_components",
    f"""WITH {PRESSURES} SELECT session, sn, t, unnest(['BP_SYS', 'BP_DIA', 'BP_MAP']) AS param, unnest([sys, dia, map]) AS value FROM bp""",
)
def cuff_components(spark, sf):
    return codes.components(cuff(spark, sf), "BP")


@query(
    "P14_repaired_log_time",
    f"""WITH {PACKETS}, b AS (SELECT seq, CASE seq % 5 WHEN 0 THEN NULL WHEN 1 THEN 99999 WHEN 2 THEN 4070937600001 ELSE tm END AS tm, tm AS doc_tm, CASE WHEN seq % 2 = 0 THEN segment END AS segment FROM packets)
    SELECT seq, CASE WHEN tm IS NULL OR tm < 100000 OR tm > 4070937600000 THEN doc_tm ELSE tm END AS tm, coalesce(segment, 0) AS segment FROM b""",
)
def repaired_log_time(spark, sf):
    p = _packets(spark, sf)
    n = F.col("seq") % 5
    broken = F.when(n == 0, None).when(n == 1, 99999).when(n == 2, 4070937600001).otherwise(F.col("tm"))
    p = p.withColumn("doc_tm", F.col("tm")).withColumn("tm", broken)
    p = p.withColumn("segment", F.when(F.col("seq") % 2 == 0, F.col("segment")))
    return pk.repaired(p).select("seq", "tm", "segment")


@query(
    "P15_time_window",
    f"WITH {READINGS} SELECT session, param, seq FROM readings WHERE t >= 1704816000 AND t <= 1705420800",
)
def time_window(spark, sf):
    start, stop = clock.window_arguments("2024-01-09 08:00:00", "2024-01-16 08:00:00", "America/Los_Angeles")
    return readings(spark, sf).where(clock.in_window(F.col("t"), start, stop)).select("session", "param", "seq")


@query(
    "P17_active_alarms",
    """WITH a AS (SELECT o_custkey AS session, o_orderkey AS sn, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' GROUP BY ALL)
    SELECT a.session, a.sn, coalesce(l.l_partkey % 50, 999) AS code, l.l_linenumber AS state, a.n AS active FROM a LEFT JOIN lineitem l ON l.l_orderkey = a.sn AND l.l_returnflag = 'R'""",
)
def active_alarms(spark, sf):
    li = table(spark, sf, "lineitem").where("l_returnflag = 'R'")
    lists = li.groupBy("l_orderkey").agg(
        F.collect_list(
            F.struct(
                (F.col("l_partkey") % 50).alias("code"), F.lit(1).alias("severity"),
                F.col("l_linenumber").alias("state"), F.col("l_suppkey").alias("start_sn"),
            )
        ).alias("alarms")
    )
    empty = F.array().cast(lists.schema["alarms"].dataType)
    packets = (
        table(spark, sf, "orders")
        .join(lists, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .select(
            F.col("o_custkey").alias("session"), F.col("o_orderkey").alias("sn"), F.lit(0.0).alias("t"),
            F.coalesce("alarms", empty).alias("alarms"), F.lit(0).alias("status"),
        )
    )
    rows, status = pk.active_alarms(packets)
    return rows.join(status.select("session", "sn", F.col("active").cast("bigint").alias("active")), ["session", "sn"]).select(
        "session", "sn", "code", "state", "active"
    )


@query(
    "P18_session_files",
    """SELECT l_orderkey, l_linenumber, 'arr' || l_linenumber AS name FROM lineitem""",
)
def session_files(spark, sf):
    li = table(spark, sf, "lineitem")
    path = F.concat_ws("/", F.lit("tier1"), F.col("l_suppkey").cast("string"), F.lit("0001"), F.concat(F.lit("arr"), F.col("l_linenumber"), F.lit(".npz.x")))
    return li.select("l_orderkey", "l_linenumber", text.session_file(path).alias("name"))


@query(
    "P19_typed_readings",
    f"""WITH {PACKETS}, p AS (SELECT *, ['TIME_SYNC', 'PR', 'HR', 'SPO2', 'RR'][id] AS param FROM packets)
    SELECT session, param, sn, NULL::DOUBLE AS t, CAST(f AS INT) AS field, CASE f WHEN 0 THEN value WHEN 1 THEN value * 2 ELSE value + 1 END AS value FROM p, range(3) g(f) WHERE id IN (2, 3)
    UNION ALL SELECT session, 'PR', sn, NULL, CAST(f AS INT), CAST(seq + f AS DOUBLE) FROM p, range(2) g(f) WHERE id = 4
    UNION ALL SELECT session, 'TIME_SYNC', sn, tm / 1000.0, 0, CAST(device AS DOUBLE) FROM p WHERE id = 1
    UNION ALL SELECT session, 'ANALYTICS_' || seq % 3, sn, tm / 1000.0, 0, value FROM p WHERE id = 5""",
)
def typed_readings(spark, sf):
    """Pass-through packets share the name PR with a numeric family; both stay."""
    p = _packets(spark, sf)
    names = F.array(*[F.lit(x) for x in ("TIME_SYNC", "PR", "HR", "SPO2", "RR")])
    p = p.withColumn("param", F.get(names, F.col("id").cast("int") - 1))
    numeric = p.where("id in (2, 3)").withColumn("values", F.array("value", F.col("value") * 2, F.col("value") + 1))
    passed = p.where("id = 4").withColumn("param", F.lit("PR")).withColumn("values", F.array(F.lit(0.0), F.col("seq").cast("double"), F.col("seq") + 1.0))
    syncs = p.where("id = 1").withColumn("tm_ms", F.col("tm"))
    extra = p.where("id = 5").withColumn("tm_ms", F.col("tm")).withColumn("subtype", F.col("seq") % 3)
    return pk.typed_readings(numeric, passed, syncs, extra.withColumn("values", F.array("value")))


@query(
    "P20_device_sessions",
    """SELECT user_id AS group_id, event_id AS device_id, epoch_ms(date_trunc('second', ts)) AS t0,
      CASE WHEN event_id % 4 <> 0 THEN epoch_ms(date_trunc('second', ts)) END AS t1 FROM events""",
)
def device_sessions(spark, sf):
    e = table(spark, sf, "events")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    raw = e.select(
        (F.col("user_id") + 5000).alias("group_id"),
        F.col("event_id").alias("device_id"),
        iso.alias("start_time"),
        F.when(F.col("event_id") % 4 != 0, iso).otherwise(F.lit("")).alias("stop_time"),
    )
    return pk.device_sessions(raw, 5000)


# ---- counts, sets, order ------------------------------------------------------------


@query(
    "A19_packet_counts",
    f"WITH {PACKETS} SELECT session, block, CAST(id AS INT) AS id, count(*) AS packets FROM packets GROUP BY ALL",
)
def packet_counts(spark, sf):
    return ingest.packet_counts(_packets(spark, sf)).withColumn("id", F.col("id").cast("int"))


@query(
    "A19_block_devices",
    f"WITH {PACKETS} SELECT session, block, arg_min(seq % 7, seq) AS device FROM packets GROUP BY ALL",
)
def block_devices(spark, sf):
    return ingest.block_devices(_packets(spark, sf).withColumn("device", F.col("seq") % 7))


@query(
    "A20_distinct_names",
    "SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority LIKE '%-%' AND o_orderpriority NOT LIKE '%LOW%'",
)
def distinct_names(spark, sf):
    return stored.distinct_names(table(spark, sf, "orders"), "o_orderpriority", "%-%", "%LOW%")


@query(
    "A21_pending_blocks",
    """WITH x AS (SELECT o_orderstatus AS status, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus)
    SELECT status, CAST(sum(n) AS BIGINT) AS blocks FROM x GROUP BY status""",
)
def pending_blocks(spark, sf):
    lists = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.to_json(F.collect_list("l_linenumber")).alias("blocks")
    )
    index = table(spark, sf, "orders").join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return stored.pending_blocks(index.select(F.col("o_orderstatus").alias("status"), "blocks"))


@query(
    "A22_collected_results",
    """SELECT o_orderpriority AS test, o_custkey AS record, o_orderkey AS result, row_number() OVER (PARTITION BY o_orderpriority, o_custkey ORDER BY o_orderkey) AS place
    FROM orders WHERE o_orderstatus <> 'P'""",
)
def collected_results(spark, sf):
    from ..operators.hist import collected

    o = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("test"), F.col("o_custkey").alias("record"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("result"),
    )
    return collected(o, ["test", "record"], "result")


@query(
    "O1_ordered_rows",
    f"WITH {PACKETS} SELECT tm, sn, session FROM packets ORDER BY tm, sn, session",
)
def ordered_rows(spark, sf):
    return _packets(spark, sf).select("tm", "sn", "session").orderBy("tm", "sn", "session")


@query("O2_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def limited(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(25)


@query(
    "O3_page",
    f"WITH {READINGS}, b AS (SELECT session, block, min(t) AS start FROM readings GROUP BY ALL) SELECT session, block, start FROM b ORDER BY start, session, block LIMIT 100 OFFSET 300",
)
def page(spark, sf):
    blocks = readings(spark, sf).groupBy("session", "block").agg(F.min("t").alias("start"))
    return stored.page(blocks, ["start", "session", "block"], 3, 100)


@query("O4_sorted_series", f"WITH {READINGS} SELECT session, block, param, sn FROM readings WHERE sn > 0")
def sorted_series(spark, sf):
    r = readings(spark, sf).where("sn > 0").select("session", "block", "param", "sn")
    return r.repartition("session", "block").sortWithinPartitions("session", "block", "param", "sn")


@query("T1_union_distinct", "SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer")
def union_distinct(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    return a.union(table(spark, sf, "customer").select("c_custkey")).distinct()


@query(
    "T2_union_all",
    "SELECT user_id, event_id FROM events WHERE event_type = 'view' UNION ALL SELECT user_id, event_id FROM events WHERE event_type = 'error'",
)
def union_all(spark, sf):
    """Two slices of one table are one scan with either condition."""
    e = table(spark, sf, "events")
    return e.where("event_type = 'view' or event_type = 'error'").select("user_id", "event_id")


@query(
    "T3_set_difference",
    f"""WITH {READINGS}, x AS (SELECT session, block, list_sort(list(DISTINCT param)) AS p FROM readings GROUP BY ALL)
    SELECT session, block, array_to_string(list_filter(['HR', 'PR', 'RR', 'SPO2'], lambda v: NOT list_contains(p, v)), ',') AS missing,
      array_to_string(list_filter(['HR', 'PR', 'RR', 'SPO2'], lambda v: list_contains(p, v)), ',') AS present FROM x""",
)
def set_difference(spark, sf):
    spans = ingest.block_spans(readings(spark, sf))
    wanted = F.array(*[F.lit(p) for p in ("HR", "PR", "RR", "SPO2")])
    return spans.select(
        "session", "block", F.array_join(F.array_except(wanted, "params"), ",").alias("missing"),
        F.array_join(F.array_intersect(wanted, "params"), ",").alias("present"),
    )


@query(
    "T4_first_of_each_alarm",
    f"WITH {ALARMS} SELECT session, code, start_sn, min(seq) AS seq, arg_min(t, seq) AS t FROM (SELECT DISTINCT * FROM alarms) GROUP BY session, code, start_sn",
)
def first_of_each_alarm(spark, sf):
    from ..operators.asof import first_of_each

    a = device_alarms(spark, sf).distinct().select("session", "code", "start_sn", "seq", "t")
    return first_of_each(a, ["session", "code", "start_sn"])


@query(
    "J11_semi_join",
    f"""WITH {READINGS} SELECT session, block, sn, seq FROM readings r WHERE param = 'PR' AND EXISTS (SELECT 1 FROM readings m WHERE m.param = 'HR' AND m.session = r.session AND m.block = r.block AND m.value > 40)""",
)
def semi_join(spark, sf):
    r = readings(spark, sf)
    marks = r.where("param = 'HR' and value > 40").select("session", "block")
    return r.where("param = 'PR'").join(marks, ["session", "block"], "left_semi").select("session", "block", "sn", "seq")


TAGS = """tags AS (SELECT doc_id AS annid, 'lang:' || lang AS tag FROM documents UNION ALL SELECT doc_id, 'source:' || source FROM documents
  UNION ALL SELECT doc_id, 'quality:' || quality FROM labels UNION ALL SELECT doc_id, 'lang:' || lang FROM documents WHERE n_chars > 500)"""


def _tags(spark, sf):
    d = table(spark, sf, "documents")
    lang = d.select(F.col("doc_id").alias("annid"), F.concat(F.lit("lang:"), "lang").alias("tag"))
    source = d.select(F.col("doc_id").alias("annid"), F.concat(F.lit("source:"), "source").alias("tag"))
    quality = table(spark, sf, "labels").select(F.col("doc_id").alias("annid"), F.concat(F.lit("quality:"), "quality").alias("tag"))
    again = d.where("n_chars > 500").select(F.col("doc_id").alias("annid"), F.concat(F.lit("lang:"), "lang").alias("tag"))
    return lang.unionByName(source).unionByName(quality).unionByName(again)


@query(
    "J12_annotations_with_all_tags",
    f"""WITH {TAGS}, ok AS (SELECT annid FROM tags WHERE tag IN ('lang:en', 'quality:1') GROUP BY annid HAVING count(DISTINCT tag) = 2)
    SELECT d.doc_id AS id, d.n_chars AS start_time, (SELECT string_agg(DISTINCT tag, ' ' ORDER BY tag) FROM tags WHERE tags.annid = d.doc_id) AS tags
    FROM documents d WHERE d.doc_id IN (SELECT annid FROM ok)""",
)
def annotations_with_all_tags(spark, sf):
    anns = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("start_time"))
    out = notes.with_all_tags(anns, _tags(spark, sf), ["lang:en", "quality:1"])
    return out.withColumn("tags", F.array_join("tags", " "))


@query(
    "J21_annotated_blocks",
    """SELECT DISTINCT o_custkey AS session, o_orderkey % 20 AS block FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1995-01-01'""",
)
def annotated_blocks(spark, sf):
    return notes.annotated_blocks(_annotations(spark, sf), "2-HIGH", 70, "1995-01-01 00:00:00")


def _annotations(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_custkey").alias("session"), (F.col("o_orderkey") % 20).alias("block"),
        F.col("o_orderpriority").alias("annotator"), F.ascii("o_orderstatus").alias("code"),
        F.col("o_orderdate").cast("timestamp").alias("created"), (F.col("o_orderkey") % 30).alias("type_id"),
    )


@query(
    "J21_annotation_types",
    """SELECT n_name AS name, count(*) AS n FROM orders LEFT JOIN nation ON n_nationkey = o_orderkey % 30 WHERE o_orderpriority = '1-URGENT' GROUP BY n_name""",
)
def annotation_types(spark, sf):
    types = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    a = _annotations(spark, sf).where(F.col("annotator") == "1-URGENT")
    named = a.join(types.withColumnRenamed("id", "type_id"), "type_id", "left")
    return named.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


