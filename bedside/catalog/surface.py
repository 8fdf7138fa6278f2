"""Documents with unknown keys, and the library called from SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sql
from ..sources import documents as doc
from . import ORACLES, query
from .base import READINGS, readings, table
from .intervals import _chunks
from .waves import _signal

# ---- documents -----------------------------------------------------------------


def _partials(spark, sf):
    """Partial documents: some keys come and go, some are null, every 50th is torn."""
    n = F.col("seq")
    text = F.concat(
        F.lit('{"ARRAYS":{"'), "param", F.lit('":'), n, F.lit('},"DEVICES":['), n % 13, F.lit('],"EXTRA_'), n % 5, F.lit('":"v'),
        n % 100, F.lit('","T1":'), F.col("t").cast("bigint"), F.when(n % 7 == 0, F.lit(',"NOTE":{"by":null}')).otherwise(""), F.lit("}"),
    )
    rows = readings(spark, sf)
    return doc.parsed(rows.select("session", "block", "seq", F.when(n % 50 == 0, "{torn").otherwise(text).alias("document")))


DOCUMENTS = READINGS + """, p AS (SELECT * FROM readings WHERE seq % 50 <> 0),
 named AS (SELECT session, block, 'EXTRA_' || seq % 5 AS k, '"v' || seq % 100 || '"' AS v, seq FROM p
   UNION ALL SELECT session, block, 'T1', CAST(CAST(t AS BIGINT) AS VARCHAR), seq FROM p
   UNION ALL SELECT session, block, 'NOTE', '{"by":null}', seq FROM p WHERE seq % 7 = 0),
 parts AS (SELECT session, block, k, arg_max(v, seq) AS v FROM named GROUP BY ALL
   UNION ALL SELECT session, block, 'ARRAYS', '{' || string_agg('"' || param || '":' || s, ',' ORDER BY param) || '}'
     FROM (SELECT session, block, param, max(seq) AS s FROM p GROUP BY ALL) GROUP BY ALL
   UNION ALL SELECT session, block, 'DEVICES', '[' || string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) || ']'
     FROM (SELECT DISTINCT session, block, seq % 13 AS d FROM p) GROUP BY ALL)"""


@query(
    "S5_document_merge",
    f"""WITH {DOCUMENTS}, whole AS (SELECT session, block, '{{' || string_agg('"' || k || '":' || v, ',' ORDER BY k) || '}}' AS document FROM parts GROUP BY ALL)
    SELECT r.session, r.block, coalesce(any_value(document), '{{"ARRAYS":{{}},"DEVICES":[]}}') AS document, count(*) FILTER (WHERE r.seq % 50 = 0) AS unread
    FROM readings r LEFT JOIN whole w ON w.session = r.session AND w.block = r.block GROUP BY r.session, r.block""",
)
def document_merge(spark, sf):
    return doc.merged_documents(_partials(spark, sf)).withColumn("document", F.to_json("document"))


@query(
    "S5_document_keys",
    f"""WITH {DOCUMENTS} SELECT k AS key, count(*) AS documents, CASE k WHEN 'T1' THEN 'BIGINT' WHEN 'NOTE' THEN 'OBJECT<by: VOID>' ELSE 'STRING' END AS kind
    FROM named GROUP BY k""",
)
def document_keys(spark, sf):
    """The keys nobody foresaw."""
    return doc.document_keys(_partials(spark, sf), known=[*doc.MAPS, *doc.SETS])


def _jobs(spark, sf):
    """An order lists its own line items as files and blocks; some have neither list."""
    o = F.col("o_orderkey")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list("l_linenumber")).alias("lines"))
    made = F.to_json(
        F.struct(
            F.array(F.concat(F.lit("meta-"), o), F.concat(F.lit("log-"), o)).alias("files"),
            F.when(o % 3 != 0, F.col("lines")).alias("blocks"),
        )
    )
    jobs = table(spark, sf, "orders").join(lines, o == F.col("l_orderkey"), "left")
    return doc.parsed(jobs.select(F.col("o_orderstatus").alias("status"), F.when(o % 10 != 0, made).alias("document")))


@query("S6_document_worklist", "SELECT DISTINCT 'meta-' || o_orderkey AS name FROM orders WHERE o_orderkey % 10 <> 0")
def document_worklist(spark, sf):
    return doc.listed_names(_jobs(spark, sf))


@query(
    "A21_pending_documents",
    """SELECT o_orderstatus AS status, CAST(count(l_orderkey) FILTER (WHERE o_orderkey % 10 <> 0 AND o_orderkey % 3 <> 0) AS BIGINT) AS blocks
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderstatus""",
)
def pending_documents(spark, sf):
    return doc.pending_in_documents(_jobs(spark, sf))


# ---- SQL -----------------------------------------------------------------------


def _run(spark, text, **views):
    sql.register(spark)
    return spark.sql(text, **views)


@query("P16_samples_in_sql", ORACLES["P16_exploded_samples"])
def samples_in_sql(spark, sf):
    return _run(
        spark,
        """SELECT vec_id, tick AS sn, max(value) FILTER (WHERE channel = 0) AS a, max(value) FILTER (WHERE channel = 1) AS b
        FROM {packets}, LATERAL sample_rows(vec_id * 1000, CAST(embedding AS ARRAY<DOUBLE>), IF(label % 2 = 0, 125, 250), 2)
        GROUP BY vec_id, tick""",
        packets=table(spark, sf, "embeddings"),
    )


@query("P17_alarms_in_sql", ORACLES["P17_active_alarms"])
def alarms_in_sql(spark, sf):
    return _run(
        spark,
        """SELECT session, sn, code, state, active FROM (
          SELECT o_custkey AS session, o_orderkey AS sn, count(l_orderkey) AS active, collect_list(
            CASE WHEN l_orderkey IS NOT NULL THEN named_struct('code', l_partkey % 50, 'severity', 1, 'state', CAST(l_linenumber AS INT), 'start_sn', CAST(l_suppkey AS BIGINT)) END) AS alarms
          FROM {orders} LEFT JOIN {lines} ON l_orderkey = o_orderkey AND l_returnflag = 'R' GROUP BY o_custkey, o_orderkey),
        LATERAL alarm_rows(alarms)""",
        orders=table(spark, sf, "orders"),
        lines=table(spark, sf, "lineitem"),
    )


@query("W16_blocks_in_sql", ORACLES["W16_planned_blocks"])
def blocks_in_sql(spark, sf):
    return _run(
        spark,
        """WITH segments AS (SELECT session, segment, min_by(sn0, num) AS min_sn, max_by(sn1, num) AS max_sn FROM {chunks} GROUP BY session, segment)
        SELECT * FROM block_rows(TABLE(segments))""",
        chunks=_chunks(spark, sf),
    )


@query(
    "P7_serials_in_sql",
    f"""WITH {READINGS} SELECT seq, CASE WHEN value < 0 AND value > -4 THEN 'XX' WHEN value = -4 THEN '++' WHEN value = -5 THEN '--' WHEN value < 0 THEN 'OFF' END AS state,
      '????20' || lpad(CAST(((seq * 4097) >> 18 & 63) + 13 AS VARCHAR), 2, '0') || lpad(CAST((seq * 4097) >> 14 & 15 AS VARCHAR), 2, '0') || lpad(CAST((seq * 4097) & 16383 AS VARCHAR), 5, '0') AS serial_no
    FROM readings""",
)
def codes_in_sql(spark, sf):
    return _run(
        spark,
        "SELECT seq, reading_state(recoded(value)) AS state, serial_number(seq * 4097) AS serial_no FROM {r}",
        r=readings(spark, sf),
    )


@query("U3_variability_in_sql", ORACLES["U3_variability"])
def variability_in_sql(spark, sf):
    """A feature of a user's own, registered by name."""

    def own(rr):
        steps = rr[1:] - rr[:-1]
        return float((steps @ steps / (len(steps) - 1)) ** 0.5 / rr.mean())

    sql.register_feature(spark, "own_variability", own)
    return spark.sql(
        "SELECT vec_id, round(own_variability(transform(a, x -> 500 + 100 * x)), 8) AS variability FROM {w}",
        w=_signal(spark, sf),
    )
