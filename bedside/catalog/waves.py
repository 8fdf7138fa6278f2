"""Waveform packets, windows and rhythm features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import channels as ch
from ..operators import features as ft
from ..operators import waveform as wf
from ..plans.rhythm_model import RhythmModel, out_of_fold, training_rows
from . import ORACLES, query
from .base import READINGS, readings, table
from .intervals import marks_to_intervals

LEADS = ["ECG_I", "ECG_II", "ECG_III"]


def _vectors(spark, sf):
    return table(spark, sf, "embeddings")


def samples(spark, sf):
    """A long waveform per (label, block of 100 vectors): 64 ticks a vector."""
    e = _vectors(spark, sf).select(
        F.col("label").cast("bigint").alias("session"),
        F.floor(F.col("vec_id") / 100).alias("block"),
        "vec_id",
        F.posexplode("embedding").alias("i", "v"),
    )
    return e.select(
        "session", "block", (F.col("vec_id") * 64 + F.col("i")).alias("sn"),
        F.floor(F.col("v").cast("double") * 4000).alias("value"), "i",
    )


SAMPLES = """samples AS (SELECT CAST(label AS BIGINT) AS session, vec_id // 100 AS block, vec_id * 64 + i AS sn, CAST(floor(CAST(v AS DOUBLE) * 4000) AS BIGINT) AS value, i
  FROM (SELECT label, vec_id, unnest(embedding) AS v, unnest(range(64)) AS i FROM embeddings))"""


@query(
    "P16_exploded_samples",
    """WITH x AS (SELECT vec_id, label, CASE WHEN label % 2 = 0 THEN 125 ELSE 250 END AS rate, unnest(range(32)) AS i, embedding FROM embeddings)
    SELECT vec_id, vec_id * 1000 + i * (500 // rate) AS sn, CAST(embedding[i * 2 + 1] AS DOUBLE) AS a, CAST(embedding[i * 2 + 2] AS DOUBLE) AS b FROM x""",
)
def exploded_samples(spark, sf):
    p = _vectors(spark, sf).select(
        "vec_id", (F.col("vec_id") * 1000).alias("sn"),
        F.when(F.col("label") % 2 == 0, 125).otherwise(250).alias("sample_rate"),
        F.col("embedding").cast("array<double>").alias("samples"),
    )
    return wf.explode_samples(p, ["a", "b"])


def _leads(spark, sf):
    names = F.array(*[F.lit(n) for n in LEADS])
    s = samples(spark, sf)
    return s.select(
        "session", "block", (F.col("sn") - F.col("sn") % 2).alias("sn"), F.get(names, F.col("i") % 3).alias("lead"),
        F.col("i").alias("seq"), "value",
    )


LONG = SAMPLES + """, leads AS (SELECT session, block, sn - sn % 2 AS sn, ['ECG_I', 'ECG_II', 'ECG_III'][i % 3 + 1] AS lead, i AS seq, value FROM samples)"""


def _wide_sql(missing: int, value: str = "value") -> str:
    cells = ", ".join(
        f"coalesce(arg_min({value}, seq) FILTER (WHERE lead = '{n}'), {missing}) AS {n}" for n in LEADS
    )
    return f"""sp AS (SELECT session, block, min(sn) AS lo, max(sn) AS hi FROM leads GROUP BY ALL),
    g AS (SELECT session, block, unnest(generate_series(lo, hi)) AS sn FROM sp)
    SELECT g.session, g.block, g.sn, {cells} FROM g LEFT JOIN leads l ON l.session = g.session AND l.block = g.block AND l.sn = g.sn GROUP BY g.session, g.block, g.sn"""


@query("P13_wide_leads", f"WITH {LONG}, {_wide_sql(-(2**31))}")
def wide_leads(spark, sf):
    return wf.leads_wide(_leads(spark, sf), LEADS)


@query(
    "P13_long_leads",
    f"""WITH {LONG} SELECT session, block, sn, lead, arg_min(value, seq) AS value FROM leads GROUP BY ALL""",
)
def long_leads(spark, sf):
    return wf.leads_long(wf.leads_wide(_leads(spark, sf), LEADS, dense=False), LEADS)


@query(
    "J10_merged_leads",
    f"WITH {LONG}, {_wide_sql(2**23 - 32, 'CASE WHEN value * 20000 >= 8388576 OR value * 20000 <= -8388576 THEN 8388576 ELSE value * 20000 END')}",
)
def merged_leads(spark, sf):
    s = _leads(spark, sf).withColumn("value", F.col("value") * 20000)
    return wf.merged_ecg(s, LEADS)


def _channels(spark, sf, names, every):
    """Channels at their own rates with repeated ticks; some samples lack their time, some their value."""
    s = samples(spark, sf)
    parts = [
        s.where(F.col("i") % n == 0).select(
            "session", "block", (F.col("sn") - F.col("sn") % 3 * (k % 2)).alias("sn"), F.lit(c).alias("lead"), F.col("i").alias("seq"),
            F.when(F.col("i") % 5 != 2, F.col("sn") / 500.0 + k * 0.125).alias("t"),
            F.when(F.col("i") % 16 != 8, F.col("value").cast("double") * (k + 1)).alias("value"),
        )
        for k, (c, n) in enumerate(zip(names, every))
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _channels_sql(names, every) -> str:
    parts = " UNION ALL ".join(
        f"SELECT session, block, sn - sn % 3 * {k % 2} AS sn, '{c}' AS lead, i AS seq, CASE WHEN i % 5 <> 2 THEN sn / 500.0 + {k * 0.125} END AS t, CASE WHEN i % 16 <> 8 THEN CAST(value AS DOUBLE) * {k + 1} END AS value FROM samples WHERE i % {n} = 0"
        for k, (c, n) in enumerate(zip(names, every))
    )
    return f"""{SAMPLES}, raw AS ({parts}), one AS (SELECT session, block, sn, lead, f.t AS t, f.value AS value FROM (SELECT session, block, sn, lead, arg_min({{'t': t, 'value': value}}, seq) AS f FROM raw GROUP BY ALL))"""


def _merged_sql(source: str, names, missing: int, unknown: int, keep: str = "true") -> str:
    cells = ", ".join(f"any_value({{'t': t, 'v': value}}) FILTER (WHERE lead = '{c}') AS c{k}" for k, c in enumerate(names))
    known = ", ".join(f"c{k}.t" for k in reversed(range(len(names))))
    values = ", ".join(f"CASE WHEN c{k} IS NULL THEN {missing} ELSE coalesce(c{k}.v, {unknown}) END AS {c}" for k, c in enumerate(names))
    return f"""sp AS (SELECT session, block, min(sn) AS lo, max(sn) AS hi FROM {source} GROUP BY ALL), gr AS (SELECT session, block, unnest(generate_series(lo, hi)) AS sn FROM sp),
    wide AS (SELECT session, block, sn, {cells} FROM {source} GROUP BY ALL), m AS (SELECT *, coalesce({known}) AS kt FROM gr LEFT JOIN wide USING (session, block, sn)),
    z AS (SELECT *, last_value(CASE WHEN kt IS NOT NULL THEN {{'sn': sn, 't': kt}} END IGNORE NULLS) OVER (PARTITION BY session, block ORDER BY sn ROWS UNBOUNDED PRECEDING) AS b,
      first_value(CASE WHEN kt IS NOT NULL THEN {{'sn': sn, 't': kt}} END IGNORE NULLS) OVER (PARTITION BY session, block ORDER BY sn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM m),
    y AS (SELECT session, block, sn, round(CAST(coalesce(kt, b.t + (sn - b.sn) * (a.t - b.t) / (a.sn - b.sn), b.t, a.t) AS DOUBLE), 6) AS t, {values} FROM z)
    SELECT session, block, sn, t, {', '.join(f'round(CAST({c} AS DOUBLE), 4) AS {c}' for c in names)} FROM y WHERE {keep}"""


def _rounded_channels(out):
    return out.select("session", "block", "sn", F.round("t", 6).alias("t"), *[F.round(F.col(c).cast("double"), 4).alias(c) for c in out.columns[4:]])


OPTICAL, SEISMIC, PRESSURE = (["IR_FILT", "IR_DC", "RED_DC"], [2, 8, 16]), (["SCG"], [7]), (["PRES_A", "PRES_B"], [4, 6])


@query(
    "J10_optical",
    f"""WITH {_channels_sql(*OPTICAL)}, u AS (SELECT session, block, lead, sn, 0 AS k, t, value FROM one WHERE lead <> 'IR_FILT'
      UNION ALL SELECT session, block, unnest(['IR_DC', 'RED_DC']) AS lead, sn, 1, t, NULL FROM one WHERE lead = 'IR_FILT'),
    n AS (SELECT *, last_value(CASE WHEN k = 0 THEN {{'sn': sn, 'v': value}} END IGNORE NULLS) OVER (PARTITION BY session, block, lead ORDER BY sn, k ROWS UNBOUNDED PRECEDING) AS b,
      first_value(CASE WHEN k = 0 THEN {{'sn': sn, 'v': value}} END IGNORE NULLS) OVER (PARTITION BY session, block, lead ORDER BY sn, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM u),
    raised AS (SELECT session, block, sn, lead, t, value FROM one WHERE lead = 'IR_FILT' UNION ALL
      SELECT session, block, sn, lead, t, CASE WHEN b.sn = sn THEN b.v ELSE b.v + (sn - b.sn) * (a.v - b.v) / (a.sn - b.sn) END FROM n WHERE k = 1),
    {_merged_sql('raised', OPTICAL[0], -(2**31), 645000000)}""",
)
def optical(spark, sf):
    return _rounded_channels(ch.merged_optical(_channels(spark, sf, *OPTICAL), "IR_FILT", ["IR_DC", "RED_DC"]))


@query("J10_seismic", f"WITH {_channels_sql(*SEISMIC)}, {_merged_sql('one', SEISMIC[0], 2**32 - 1, 2**32 - 1)}")
def seismic(spark, sf):
    return _rounded_channels(ch.merged_seismic(_channels(spark, sf, *SEISMIC), SEISMIC[0]))


@query(
    "J10_pressure",
    f"WITH {_channels_sql(*PRESSURE)}, {_merged_sql('one', PRESSURE[0], 2**32 - 1, 2**32 - 1, 'PRES_A <> 4294967295 OR PRES_B <> 4294967295')}",
)
def pressure(spark, sf):
    return _rounded_channels(ch.merged_pressure(_channels(spark, sf, *PRESSURE), PRESSURE[0]))


@query(
    "W17_beat_windows",
    f"""WITH {READINGS}, b AS (SELECT session, t, seq, value FROM readings WHERE param = 'HR'),
    sp AS (SELECT session, min(t) AS t0, max(t) AS t1 FROM b GROUP BY session),
    u AS (SELECT session, u AS "update", t0 + u * 86400.0 AS stop FROM (SELECT *, unnest(range(CAST(ceil((t1 - t0) / 86400) AS BIGINT))) AS u FROM sp)),
    r AS (SELECT u.session, u."update", u.stop, b.t, b.seq, b.value, row_number() OVER (PARTITION BY u.session, u."update" ORDER BY b.t DESC, b.seq DESC) AS k
      FROM u JOIN b ON b.session = u.session AND b.t >= u.stop - 432000 AND b.t <= u.stop)
    SELECT session, "update", CAST(stop AS DOUBLE) AS stop, count(*) AS beats, min(t) AS first_t, round(sum(value), 4) AS total FROM r WHERE k <= 3 GROUP BY ALL""",
)
def beat_windows(spark, sf):
    beats = readings(spark, sf).where("param = 'HR'").select("session", "t", "seq", F.col("value").alias("rr"))
    w = wf.beat_windows(beats, 3, 432000.0, 86400.0)
    return w.select(
        "session", "update", "stop", F.size("rr").cast("bigint").alias("beats"), F.array_min("ts").alias("first_t"),
        F.round(ft.total(F.col("rr")), 4).alias("total"),
    )


@query(
    "W18_fixed_windows",
    f"""WITH {SAMPLES}, k AS (SELECT * FROM samples WHERE sn % 4 = 0), sp AS (SELECT session, block, min(sn) AS a, max(sn) AS z FROM k GROUP BY ALL)
    SELECT k.session, k.block, a + ((sn - a) // 512) * 512 AS start, a + ((sn - a) // 512 + 1) * 512 AS stop, string_agg(CAST(value AS VARCHAR), ' ' ORDER BY sn) AS samples
    FROM k JOIN sp ON sp.session = k.session AND sp.block = k.block WHERE (sn - a) // 512 < (z - a) // 512 GROUP BY ALL""",
)
def fixed_windows(spark, sf):
    w = wf.fixed_windows(samples(spark, sf).drop("i"), 512, 4)
    return w.withColumn("samples", F.array_join(F.col("samples").cast("array<string>"), " "))


V = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"
VECTORS = f"v AS (SELECT vec_id, label, {V} AS a FROM embeddings)"


def _signal(spark, sf):
    return _vectors(spark, sf).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("a"))


@query(
    "U1_sample_entropy",
    f"""WITH {VECTORS}, p AS (SELECT vec_id, unnest(range(62)) AS i, a, 0.2 * list_aggregate(a, 'stddev_pop') AS r FROM v),
    q AS (SELECT vec_id, i, unnest(range(i + 1, 62)) AS j, a, r FROM p),
    d AS (SELECT vec_id, greatest(abs(a[i + 1] - a[j + 1]), abs(a[i + 2] - a[j + 2])) < r AS s, greatest(abs(a[i + 1] - a[j + 1]), abs(a[i + 2] - a[j + 2]), abs(a[i + 3] - a[j + 3])) < r AS l FROM q),
    c AS (SELECT vec_id, sum(CASE WHEN s THEN 1 ELSE 0 END) AS s, sum(CASE WHEN l THEN 1 ELSE 0 END) AS l FROM d GROUP BY vec_id)
    SELECT vec_id, CASE WHEN l > 0 THEN round(ln(CAST(s AS DOUBLE) / l), 6) END AS entropy FROM c""",
)
def sample_entropy(spark, sf):
    s = _signal(spark, sf)
    return s.select("vec_id", F.round(ft.sample_entropy(F.col("a")), 6).alias("entropy"))


@query(
    "U2_entropy_profile",
    f"""WITH {VECTORS}, z AS (SELECT vec_id, list_transform(a, lambda x: (x - list_aggregate(a, 'avg')) / coalesce(nullif(list_aggregate(a, 'stddev_pop'), 0), 1)) AS a FROM v),
    o AS (SELECT vec_id, a, unnest(range(1, 65)) AS i FROM z), q AS (SELECT vec_id, a, i, unnest(range(1, 65)) AS j FROM o),
    c AS (SELECT vec_id, i, j, abs(a[i] - a[j]) < 0.2 AS c0, i > 1 AND j > 1 AND abs(a[i - 1] - a[j - 1]) < 0.2 AS c1, i > 2 AND j > 2 AND abs(a[i - 2] - a[j - 2]) < 0.2 AS c2 FROM q WHERE i <> j),
    t AS (SELECT vec_id, i, j, unnest(range(CASE WHEN c1 AND c2 THEN 3 WHEN c1 THEN 2 ELSE 1 END)) AS m FROM c WHERE c0),
    g AS (SELECT vec_id, m, i, count(*) AS deg, count(*) - count_if(i - j BETWEEN 1 AND 2) AS b1, count(*) - count_if(j - i = 1) AS f1,
      count(*) - count_if(i - j BETWEEN 1 AND 4) AS b2, count(*) - count_if(j - i BETWEEN 1 AND 3) AS f2 FROM t GROUP BY ALL),
    k AS (SELECT x.vec_id, x.m, sum(x.deg) / 2 AS a, sum(CASE WHEN x.i = 64 THEN x.deg ELSE 0 END) AS tail, sum(x.deg * (x.deg - 1)) AS k0, sum(2.0 * x.f1 * coalesce(y.b1, 0)) AS k1, sum(2.0 * x.f2 * coalesce(w.b2, 0)) AS k2
      FROM g x LEFT JOIN g y ON y.vec_id = x.vec_id AND y.m = x.m AND y.i = x.i + 1 LEFT JOIN g w ON w.vec_id = x.vec_id AND w.m = x.m AND w.i = x.i + 2 GROUP BY ALL),
    l AS (SELECT vec_id, unnest(range(3)) AS m FROM v),
    n AS (SELECT l.vec_id, l.m, coalesce(h.a, 0) AS a, CASE l.m WHEN 0 THEN 2016.0 ELSE coalesce(s.a - s.tail, 0) END AS b,
      CASE l.m WHEN 0 THEN h.k0 WHEN 1 THEN h.k0 + h.k1 ELSE h.k0 + h.k1 + h.k2 END AS long, CASE l.m WHEN 0 THEN 64.0 * 63 * 62 WHEN 1 THEN s.k0 + s.k1 ELSE s.k0 + s.k1 + s.k2 END AS short
      FROM l LEFT JOIN k h ON h.vec_id = l.vec_id AND h.m = l.m LEFT JOIN k s ON s.vec_id = l.vec_id AND s.m = l.m - 1)
    SELECT vec_id, CAST(m AS INTEGER) AS length, CASE WHEN a > 0 AND b > 0 THEN round(-ln(a / b), 6) END AS entropy,
      CASE WHEN a > 0 AND b > 0 THEN round(sqrt(a / b * (1 - a / b) / b + greatest((long - short * (a / b) * (a / b)) / (b * b), 0)), 6) END AS error FROM n""",
)
def entropy_profile(spark, sf):
    s = _signal(spark, sf).select("vec_id", F.explode(ft.entropy_profile(F.col("a"), 2, 0.2, True)).alias("p"))
    return s.select("vec_id", "p.length", F.round("p.entropy", 6).alias("entropy"), F.round("p.error", 6).alias("error"))


@query(
    "U3_variability",
    f"""WITH {VECTORS}, r AS (SELECT vec_id, list_transform(a, lambda x: 500 + 100 * x) AS a FROM v),
    d AS (SELECT vec_id, a, list_sum(list_transform(range(2, 65), lambda i: (a[i] - a[i - 1]) * (a[i] - a[i - 1]))) AS ss FROM r)
    SELECT vec_id, round(sqrt(ss / 62) / (list_sum(a) / 64), 8) AS variability FROM d""",
)
def variability(spark, sf):
    rr = F.transform("a", lambda x: 500 + 100 * x)
    return _signal(spark, sf).select("vec_id", F.round(ft.variability(rr), 8).alias("variability"))


@query(
    "U4_kurtosis",
    f"WITH {VECTORS} SELECT vec_id, round(list_aggregate(a, 'kurtosis_pop') + 3, 5) AS kurtosis FROM v",
)
def kurtosis(spark, sf):
    return _signal(spark, sf).select("vec_id", F.round(ft.kurtosis(F.col("a")), 5).alias("kurtosis"))


def _band_sql(rate: int) -> str:
    """Samples over the mean magnitude after the band-pass, as a recursive table: band (vec_id, band_count)."""
    return f"""w AS (SELECT 2.0 * {rate} AS c, 2.0 * {rate} * tan(pi() * 13.0 / {rate}) AS w1, 2.0 * {rate} * tan(pi() * 16.5 / {rate}) AS w2),
    k0 AS (SELECT c, w2 - w1 AS wide, w1 * w2 AS mid, c * c + (w2 - w1) * c + w1 * w2 AS a0 FROM w),
    k AS (SELECT wide * c / a0 AS b0, (2 * mid - 2 * c * c) / a0 AS a1, (c * c - wide * c + mid) / a0 AS a2 FROM k0),
    f AS (SELECT vec_id, 1 AS i, b0 * a[1] AS y, 0.0::DOUBLE AS before FROM v, k UNION ALL
      SELECT f.vec_id, f.i + 1, b0 * a[f.i + 1] - b0 * coalesce(a[f.i - 1], 0) - a1 * y - a2 * before, y FROM f JOIN v ON v.vec_id = f.vec_id, k WHERE f.i < 64),
    m AS (SELECT vec_id, abs(y) AS y, avg(abs(y)) OVER (PARTITION BY vec_id, (i - 1) // 8) AS mean FROM f WHERE i % 8 <> 0),
    band AS (SELECT vec_id, CAST(count(CASE WHEN y > mean THEN 1 END) AS INT) AS band_count FROM m GROUP BY vec_id)"""


@query("U5_band_count", f"WITH RECURSIVE {VECTORS}, {_band_sql(125)} SELECT vec_id, band_count FROM band")
def band_count(spark, sf):
    return _signal(spark, sf).select("vec_id", ft.band_count(F.col("a")).alias("band_count"))


@query(
    "U6_crossing_share",
    f"""WITH {VECTORS}, c AS (SELECT vec_id, list_transform(a, lambda x: x - list_sum(a) / 64) AS a FROM v),
    o AS (SELECT vec_id, list_transform(a, lambda x: CASE WHEN abs(x / list_max(a)) > 0.2 THEN 1.0 ELSE 0.0 END) AS o FROM c)
    SELECT vec_id, round(CAST(list_sum(list_transform(range(6), lambda w: list_sum(o[w * 8 + 1 : w * 8 + 23]) * (100.0 / 24))) / 6 AS DOUBLE), 6) AS crossing FROM o""",
)
def crossing_share(spark, sf):
    return _signal(spark, sf).select("vec_id", F.round(ft.crossing_share(F.col("a"), rate=8), 6).alias("crossing"))


@query(
    "U7_leakage",
    f"""WITH {VECTORS}, p AS (SELECT vec_id, a, CAST(round_even(2.0 * 3.14159265 * list_sum(list_transform(a[2:63], lambda x: abs(x)))
      / list_sum(list_transform(range(2, 65), lambda i: abs(a[i] - a[i - 1]))) / 2, 0) AS BIGINT) AS h FROM v)
    SELECT vec_id, CASE WHEN h < 64 THEN round(list_sum(list_transform(range(h + 1, 65), lambda i: abs(a[i] + a[i - h]))) / list_sum(list_transform(range(h + 1, 65), lambda i: abs(a[i]) + abs(a[i - h]))), 6) END AS leakage FROM p""",
)
def leakage(spark, sf):
    return _signal(spark, sf).select("vec_id", F.round(ft.leakage(F.col("a")), 6).alias("leakage"))


@query(
    "U8_cosine_similarity",
    f"""WITH {VECTORS}, w AS (SELECT vec_id, label, a, lag(a) OVER (PARTITION BY label ORDER BY vec_id) AS b FROM v)
    SELECT vec_id, label, CASE WHEN b IS NOT NULL THEN round(list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))), 6) END AS similarity FROM w""",
)
def cosine_similarity(spark, sf):
    from ..operators.slices import balance, previous, scan, unsliced

    s = scan(balance(_signal(spark, sf), ["label"], "vec_id"), ["label"], ["vec_id"], b=previous("a"))
    sim = F.when(F.col("b").isNotNull(), ft.cosine(F.col("a"), F.col("b")))
    return unsliced(s).select("vec_id", "label", F.round(sim, 6).alias("similarity"))


@query(
    "U8_beat_similarity",
    f"""WITH {SAMPLES}, n AS (SELECT *, row_number() OVER (PARTITION BY session, block ORDER BY sn) AS pos FROM samples),
    b AS (SELECT session, block, sn FROM samples WHERE sn % 50 = 0),
    m AS (SELECT n.session, n.block, n.sn, n.pos FROM b JOIN n ON n.session = b.session AND n.block = b.block AND n.sn = b.sn WHERE n.pos > 21),
    w AS (SELECT m.session, m.block, m.sn, list(CAST(n.value AS DOUBLE) ORDER BY n.pos) AS w FROM m JOIN n ON n.session = m.session AND n.block = m.block AND n.pos BETWEEN m.pos - 20 AND m.pos + 19 GROUP BY ALL),
    l AS (SELECT b.*, w.w, lag(w.w) OVER (PARTITION BY b.session, b.block ORDER BY b.sn) AS p FROM b LEFT JOIN w ON w.session = b.session AND w.block = b.block AND w.sn = b.sn),
    s AS (SELECT session, block, sn, CASE WHEN p IS NULL OR w IS NULL THEN NULL WHEN len(p) <> len(w) THEN -1 ELSE list_dot_product(pp, w) / nullif(sqrt(list_dot_product(p, p)) * sqrt(list_dot_product(w, w)), 0)
      END AS x FROM (SELECT *, CASE WHEN len(p) = len(w) THEN p ELSE w END AS pp FROM l))
    SELECT session, block, sn, round(x, 6) AS similarity, CASE WHEN x >= 0.6 THEN 1 ELSE 0 END AS good FROM s""",
)
def beat_similarity(spark, sf):
    s = samples(spark, sf).drop("i")
    beats = s.where("sn % 50 = 0").select("session", "block", "sn")
    return ft.beat_similarity(beats, s).select(
        "session", "block", "sn", F.round("similarity", 6).alias("similarity"), "good"
    )


def _rhythm_sql(longest_gap: float, score: str) -> str:
    return f"""WITH {READINGS}, r AS (SELECT * FROM readings WHERE value > 0), b AS (SELECT session, t, seq, value FROM r WHERE param = 'HR'),
    sp AS (SELECT session, min(t) AS t0, max(t) AS t1 FROM b GROUP BY session),
    u AS (SELECT session, u AS "update", t0 + u * 86400.0 AS stop FROM (SELECT *, unnest(range(CAST(ceil((t1 - t0) / 86400) AS BIGINT))) AS u FROM sp)),
    w AS (SELECT u.session, u."update", u.stop, b.t, b.seq, b.value FROM u JOIN b ON b.session = u.session AND b.t BETWEEN u.stop - 1728000 AND u.stop
      QUALIFY row_number() OVER (PARTITION BY u.session, u."update" ORDER BY b.t DESC, b.seq DESC) <= 12),
    x AS (SELECT *, coalesce(value - lag(value) OVER (PARTITION BY session, "update" ORDER BY t, seq), 0) AS drr FROM w),
    s AS (SELECT session, "update", stop, min(t) AS t0, max(t) AS t1, count(*) AS beats, count_if(value > 5) AS good FROM x GROUP BY ALL),
    h AS (SELECT s.session, s."update", count(*) AS seen FROM s JOIN r ON r.session = s.session AND r.t BETWEEN t0 AND t1 GROUP BY ALL),
    g AS (SELECT * FROM x WHERE value > 5 QUALIFY row_number() OVER (PARTITION BY session, "update" ORDER BY t DESC, seq DESC) <= 6),
    l AS (SELECT session, "update", list(drr ORDER BY t, seq) AS d, sqrt(sum(drr * drr) / nullif(count(*) - 1, 0)) / avg(value) AS variability, 0.2 * stddev_pop(drr) AS r FROM g GROUP BY ALL),
    p AS (SELECT session, "update", d, r, unnest(range(len(d) - 2)) AS i FROM l), q AS (SELECT *, unnest(range(i + 1, len(d) - 2)) AS j FROM p),
    n AS (SELECT session, "update", greatest(abs(d[i + 1] - d[j + 1]), abs(d[i + 2] - d[j + 2])) < r AS near, abs(d[i + 3] - d[j + 3]) < r AS longer FROM q),
    e AS (SELECT session, "update", CASE WHEN count_if(near AND longer) > 0 THEN ln(count_if(near) / count_if(near AND longer)) END AS entropy FROM n GROUP BY ALL),
    f AS (SELECT s.session, s."update", stop, entropy, variability, CASE WHEN t1 - t0 - coalesce(seen, 0) > {longest_gap} OR stop - t1 > 864000 THEN -1 WHEN beats < 6 THEN 0 WHEN good < 6 THEN -2
        WHEN variability > 0 THEN CASE WHEN {score} THEN 1 ELSE 0 END ELSE -1 END AS code
      FROM s LEFT JOIN l USING (session, "update") LEFT JOIN e USING (session, "update") LEFT JOIN h USING (session, "update")),
    c AS (SELECT *, lag(code) OVER (PARTITION BY session ORDER BY "update") AS was FROM f)
    SELECT session, "update", CAST(stop AS DOUBLE) AS stop, code, round(entropy, 6) AS entropy, round(variability, 6) AS variability,
      CAST(last_value(CASE WHEN code IS DISTINCT FROM was THEN stop END IGNORE NULLS) OVER (PARTITION BY session ORDER BY "update" ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS rhythm_start FROM c"""


def _rhythm_windows(spark, sf):
    """Twenty-day beat windows of the heart-rate readings, updated daily, and all times with a reading."""
    r = readings(spark, sf).where("value > 0")
    beats = r.where("param = 'HR'").select("session", "t", "seq", F.col("value").alias("rr"))
    w = wf.beat_windows(beats, 12, 1728000.0, 86400.0)
    n = F.size("rr")
    drr = F.concat(F.array(F.lit(0.0)), F.zip_with(F.slice("rr", F.lit(2), n - 1), F.slice("rr", F.lit(1), n - 1), lambda b, a: b - a))
    w = w.withColumn("drr", drr).withColumn("good", F.transform("rr", lambda x: (x > 5).cast("int"))).withColumn("leads", F.transform("rr", lambda x: F.lit(1)))
    return w, r.select("session", "t")


def _rounded_rhythm(out):
    return out.withColumn("entropy", F.round("entropy", 6)).withColumn("variability", F.round("variability", 6))


@query("U9_rhythm_updates", _rhythm_sql(1e7, "(coalesce(entropy, -10) - 1) / 0.5 > -2 AND (variability - 1) / 0.5 > -1"))
def rhythm_updates(spark, sf):
    """Beat windows scored by a plain threshold on both features."""
    return _rounded_rhythm(ft.rhythm_updates(
        *_rhythm_windows(spark, sf), 6, (1.0, 1.0), (0.5, 0.5), lambda a, b: (a > -2) & (b > -1), update_seconds=864000.0, longest_gap=1e7, no_entropy=-10.0
    ))


@query(
    "U9_weighted_decision",
    _rhythm_sql(1.2e6, "1 / (1 + exp(-(0.4 * (coalesce(entropy, 0) - 0.5) / 0.4 + 1.5 * (variability - 0.9) / 0.3 - 0.2))) >= 0.5"),
)
def weighted_decision(spark, sf):
    """The same windows decided by a logistic model with fixed weights; wide windows with few readings are invalid."""
    model = RhythmModel((0.5, 0.9), (0.4, 0.3), (0.4, 1.5), -0.2)
    return _rounded_rhythm(ft.rhythm_updates(
        *_rhythm_windows(spark, sf), 6, model.centre, model.scale, model, update_seconds=864000.0, longest_gap=1.2e6, no_entropy=0.0
    ))


@query("U9_trained_rhythm")
def trained_rhythm(spark, sf):
    """Out-of-fold decisions of models fitted to the marked stretches of other sessions."""
    features = ft.rhythm_features(*_rhythm_windows(spark, sf), 6, 864000.0, 1e7)
    marked = marks_to_intervals(spark, sf).where("tag IN ('AFIB', 'AFL')").select("session", F.col("start").alias("begin"), F.col("stop").alias("end"))
    rows = training_rows(features, marked, span=21600.0, width=86400.0, no_entropy=0.0)
    out = out_of_fold(rows)
    return out.select("session", "update", "fold", "label", F.round("probability", 6).alias("probability"), "decided")


@query(
    "U10_fibrillation_features",
    f"""WITH RECURSIVE {VECTORS}, {_band_sql(8)}, u1 AS ({ORACLES["U1_sample_entropy"]}), u6 AS ({ORACLES["U6_crossing_share"]}), u7 AS ({ORACLES["U7_leakage"]})
    SELECT v.vec_id, round(4000 * list_max(list_transform(a, lambda x: abs(x))), 6) AS peak, CAST(band_count AS DOUBLE) AS band_count,
      coalesce(crossing, -1) AS crossing, coalesce(leakage, -1) AS leakage, coalesce(entropy, -1) AS entropy
    FROM v JOIN band ON band.vec_id = v.vec_id JOIN u1 ON u1.vec_id = v.vec_id JOIN u6 ON u6.vec_id = v.vec_id JOIN u7 ON u7.vec_id = v.vec_id""",
)
def fibrillation_features(spark, sf):
    """Vectors scaled to a few millivolts; the features but the peak do not depend on the scale."""
    s = _signal(spark, sf).withColumn("a", F.transform("a", lambda x: x * 4000))
    out = s.select("vec_id", ft.fibrillation_features(F.col("a"), 8).alias("f")).select("vec_id", "f.*")
    return out.select("vec_id", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


def _noise(spark, sf):
    s = samples(spark, sf).drop("i")
    filtered = s.select("session", "block", "sn", F.pmod(F.col("value") * 7 + F.col("sn") * 5, F.lit(32)).alias("value"))
    return filtered, s, s.withColumn("value", -F.col("value") + F.col("sn") % 50)


@query(
    "J11_radio_marks",
    f"""WITH {SAMPLES}, m AS (SELECT session, block, sn FROM samples WHERE (((value * 7 + sn * 5) % 32 + 32) % 32) % 16 = 13)
    SELECT s.session, s.block, s.sn, s.value FROM samples s JOIN m ON m.session = s.session AND m.block = s.block AND m.sn = s.sn""",
)
def radio_marks(spark, sf):
    filtered, ir, _ = _noise(spark, sf)
    return wf.at_marks(ir, wf.radio_marks(filtered))


@query("W20_noise_spikes")
def noise_spikes(spark, sf):
    filtered, ir, _ = _noise(spark, sf)
    return wf.noise_spikes(wf.mark_windows(ir, wf.radio_marks(filtered)))


@query("U12_noise_report")
def noise_report(spark, sf):
    filtered, ir, red = _noise(spark, sf)
    vitals = {
        n: ir.where(F.col("sn") % 40 == k).withColumn("value", F.col("value").cast("double"))
        for k, n in enumerate(("spo2", "pr", "hr"))
    }
    return wf.noise_report(filtered, ir, red, vitals, min_marks=20)


NOISE = f"""{READINGS}, blocks AS (SELECT session, block, min(sn) AS sn_start, max(sn) AS sn_stop FROM readings GROUP BY ALL),
 spk AS (SELECT session, block, sn AS start_sn, 0.0 AS s, value * 40 AS p, CAST(seq % 4 AS DOUBLE) AS density FROM readings WHERE param <> 'PR')"""


def _spikes(spark, sf):
    r = readings(spark, sf)
    blocks = r.groupBy("session", "block").agg(F.min("sn").alias("sn_start"), F.max("sn").alias("sn_stop"))
    spikes = r.where("param <> 'PR'").select(
        "session", "block", F.col("sn").alias("start_sn"), F.lit(0.0).alias("start_ppg"), (F.col("value") * 40).alias("peak_ppg"),
        (F.col("seq") % 4).cast("double").alias("density"),
    )
    density = r.where("param = 'PR'").select("session", "block", (F.col("seq") % 4).cast("double").alias("density"))
    return spikes, density, blocks


@query(
    "A15_noise_statistics",
    f"""WITH {NOISE}, b AS (SELECT * FROM blocks),
    a AS (SELECT session, block, abs(p - s) * (3300.0::DOUBLE / 65535) AS amp FROM spk WHERE density > 1),
    m AS (SELECT session, block, median(amp) AS mid, count(*) AS n FROM a GROUP BY ALL),
    h AS (SELECT a.session, a.block, mid, n, median(CASE WHEN amp > mid THEN amp END) AS up, median(CASE WHEN amp < mid THEN amp END) AS down, count(CASE WHEN amp >= 6 THEN 1 END) AS loud
      FROM a JOIN m ON m.session = a.session AND m.block = a.block GROUP BY ALL),
    w AS (SELECT a.session, a.block, max(CASE WHEN amp <= up + 1.5 * (up - down) THEN amp END) AS whisker FROM a JOIN h ON h.session = a.session AND h.block = a.block GROUP BY ALL),
    d AS (SELECT session, block, 100.0 * count(CASE WHEN seq % 4 >= 1 THEN 1 END) / count(*) AS d1, 100.0 * count(CASE WHEN seq % 4 >= 2 THEN 1 END) / count(*) AS d2, 100.0 * count(CASE WHEN seq % 4 >= 3 THEN 1 END) / count(*) AS d3
      FROM readings WHERE param = 'PR' GROUP BY ALL),
    j AS (SELECT b.session, b.block, (sn_stop - sn_start) / 30000.0 * 0.15 < coalesce(n, 0) AS ok, mid, up, down, whisker, loud, d1, d2, d3 FROM b
      LEFT JOIN h ON h.session = b.session AND h.block = b.block LEFT JOIN w ON w.session = b.session AND w.block = b.block LEFT JOIN d ON d.session = b.session AND d.block = b.block)
    SELECT session, block, {', '.join(f"round(CASE WHEN ok THEN CAST({x} AS DOUBLE) ELSE 0 END, 6) AS {n}" for x, n in {'mid': 'median_mv', 'up': 'upper_mv', 'down': 'lower_mv', 'whisker': 'whisker_mv', 'loud': 'loud', 'd1': 'pct_over_1', 'd2': 'pct_over_2', 'd3': 'pct_over_3'}.items())} FROM j""",
)
def noise_statistics(spark, sf):
    # readings are a day apart here, so a handful of spikes has to pass the screen
    out = wf.noise_statistics(*_spikes(spark, sf), per_minute=0.15)
    return out.select("session", "block", *[F.round(c, 6).alias(c) for c in out.columns[2:]])


@query(
    "A16_vitals_under_noise",
    f"""WITH {READINGS}, n AS (SELECT session, block, 100.0 * count(CASE WHEN value > 0 THEN 1 END) / count(*) AS dp, median(CASE WHEN value > 0 THEN value END) AS md, max(CASE WHEN value > 0 THEN value END) AS mx
      FROM readings WHERE param = 'HR' AND seq % 3 >= 1 GROUP BY ALL)
    SELECT r.session, r.block, round(CAST(coalesce(any_value(dp), -1) AS DOUBLE), 6) AS displayed_pct, round(coalesce(any_value(md), -1), 6) AS median, CAST(coalesce(any_value(mx), -1) AS DOUBLE) AS maximum
    FROM readings r LEFT JOIN n ON n.session = r.session AND n.block = r.block WHERE r.param = 'HR' GROUP BY r.session, r.block""",
)
def vitals_under_noise(spark, sf):
    rows = readings(spark, sf).where("param = 'HR'").select(
        "session", "block", "value", (F.col("seq") % 3).cast("double").alias("density")
    )
    out = wf.vitals_under_noise(rows)
    return out.select(
        "session", "block", F.round("displayed_pct", 6).alias("displayed_pct"), F.round("median", 6).alias("median"), "maximum"
    )


@query(
    "W11_turning_points",
    f"""WITH {VECTORS} SELECT vec_id, CAST(list_sum(list_transform(range(2, 64), lambda i: CASE WHEN (a[i] > a[i-1] AND a[i] > a[i+1]) OR (a[i] < a[i-1] AND a[i] < a[i+1]) THEN 1 ELSE 0 END)) AS BIGINT) AS turns FROM v""",
)
def turning_points(spark, sf):
    return _signal(spark, sf).select("vec_id", ft.turning_points(F.col("a")).cast("bigint").alias("turns"))
