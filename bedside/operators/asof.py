"""As-of joins, step lookups and the sequence-number time axis.

Both sides are stacked and the right side is carried forward along the order,
so an as-of join is one shuffle on the key and never a range product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import slices
from .slices import balance, filled, previous, refilled, refilled_after, scan, unsliced


def _stack(left, right, keys, payload, axis, seq, right_first, reduced=None):
    side = lambda is_left: F.lit(int(is_left == right_first))
    everything = F.struct(*[F.col(c) for c in left.columns])
    hit = F.struct(F.col(axis).alias("t"), *[F.col(c) for c in payload if c != axis])
    a = left.select(
        *keys,
        F.col(axis).cast("double").alias("_t"),
        side(True).alias("_side"),
        F.col(seq).cast("bigint").alias("_seq") if seq in left.columns else F.lit(0).cast("bigint").alias("_seq"),
        everything.alias("_l"),
    )
    b = right.select(
        *keys,
        F.col(axis).cast("double").alias("_t"),
        side(False).alias("_side"),
        F.col(seq).cast("bigint").alias("_seq") if seq in right.columns else F.lit(0).cast("bigint").alias("_seq"),
        hit.alias("_r"),
    )
    return balance(a.unionByName(b, allowMissingColumns=True), keys, "_t", reduced)


def _answer(df, left, keys, match: Column) -> DataFrame:
    out = df.where(F.col("_l").isNotNull()).select("_l.*", match.alias("match"))
    return out


def last_before(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    payload: Sequence[str],
    lookback: float | None = None,
    inclusive: bool = False,
    axis: str = "t",
    seq: str = "seq",
    open_lookback: bool = False,
    reduced: DataFrame | None = None,
) -> DataFrame:
    """Each left row with the last right row before it (struct ``match``).

    ``lookback`` bounds the match to ``[t - lookback, t)``; ``inclusive`` also
    allows one exactly at t; ``open_lookback`` excludes the far end.
    ``reduced`` holds the rows of both sides, if checked for size before.
    """
    df = _stack(left, right, keys, payload, axis, seq, inclusive, reduced)
    df = scan(df, keys, ["_t", "_side", "_seq"], _hit=filled("_r"))
    hit = F.col("_hit")
    if lookback is not None:
        far = F.col("_t") - float(lookback)
        near = hit["t"] > far if open_lookback else hit["t"] >= far
        hit = F.when(near, hit)
    return _answer(df, left, keys, hit)


def first_after(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    payload: Sequence[str],
    ahead: float | None = None,
    inclusive: bool = False,
    axis: str = "t",
    seq: str = "seq",
    reduced: DataFrame | None = None,
) -> DataFrame:
    """Each left row with the first right row after it, less than ``ahead`` away."""
    df = _stack(left, right, keys, payload, axis, seq, not inclusive, reduced)
    df = scan(df, keys, ["_t", "_side", "_seq"], _hit=refilled("_r"))
    hit = F.col("_hit")
    if ahead is not None:
        hit = F.when(hit["t"] - F.col("_t") < float(ahead), hit)
    return _answer(df, left, keys, hit)


def first_of_each(df: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """Keep the first row of every distinct key (counts map-side first)."""
    rest = [c for c in df.columns if c not in keys and c != seq]
    return df.groupBy(*keys).agg(
        F.min(seq).alias(seq),
        *[F.min_by(c, seq).alias(c) for c in rest],
    ).select(*df.columns)


def cuff_pairs(bp: DataFrame, continuous: DataFrame, lookback=300.0, key="session") -> DataFrame:
    """De-duplicated cuff readings with the last continuous reading before each.

    Columns: t, delta_t (from the previous cuff reading, -1 for the first),
    the cuff values and the matched reading (-1 where none).
    """
    full = [key, "t", "sys", "dia", "map", "pr", "error_code"]
    rows = bp.select(key, "t").unionByName(continuous.select(key, "t"))
    checked = balance(rows, [key], "t")
    cuff = first_of_each(bp.select(*full, "seq"), full)
    cuff = balance(cuff, [key], "t", checked)
    cuff = scan(cuff, [key], ["t", "seq"], _prev=previous("t"))
    cuff = unsliced(cuff).withColumn(
        "delta_t", F.coalesce(F.col("t") - F.col("_prev"), F.lit(-1.0))
    ).drop("_prev")
    hit = last_before(
        cuff, continuous, [key], ["sys", "dia", "map"], lookback, reduced=checked
    )
    none = F.lit(-1.0)
    return hit.select(
        key, "t", "delta_t", "sys", "dia", "map",
        F.coalesce("match.t", none).alias("c_t"),
        F.coalesce("match.sys", none).alias("c_sys"),
        F.coalesce("match.dia", none).alias("c_dia"),
        F.coalesce("match.map", none).alias("c_map"),
        "pr", "error_code",
    )


def agreement_pairs(bp: DataFrame, continuous: DataFrame, lookback=300.0, key="session") -> DataFrame:
    """Valid cuff readings paired with the last valid continuous one."""
    hit = last_before(
        bp.where("map > 0"), continuous.where("map > 0"), [key], ["sys", "dia", "map"], lookback
    ).where(F.col("match").isNotNull())
    cols = [key, "t", "sys", "dia", "map", F.col("match.t").alias("c_t")]
    for n in ("sys", "dia", "map"):
        cols.append(F.col(f"match.{n}").alias(f"c_{n}"))
    for n in ("sys", "dia", "map"):
        cols.append(((F.col(f"match.{n}") + F.col(n)) / 2.0).alias(f"mean_{n}"))
    for n in ("sys", "dia", "map"):
        cols.append((F.col(f"match.{n}") - F.col(n)).alias(f"diff_{n}"))
    return hit.select(*cols)


def agreement_summary(pairs: DataFrame, keys=()) -> DataFrame:
    """Bias and 95 % limits of agreement per measure."""
    cols = []
    for n in ("sys", "dia", "map"):
        mean, sd = F.avg(f"diff_{n}"), F.stddev_samp(f"diff_{n}")
        cols += [
            mean.alias(f"bias_{n}"),
            sd.alias(f"sd_{n}"),
            (mean - 1.96 * sd).alias(f"lower_{n}"),
            (mean + 1.96 * sd).alias(f"upper_{n}"),
        ]
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("pairs"), *cols)


def heart_rate_when_needed(hr: DataFrame, pr: DataFrame, within=3.0, key="session") -> DataFrame:
    """Heart rate kept only where the pulse rate is missing or unavailable.

    The pulse reading in force is the one at the same time or the last one
    less than ``within`` seconds before; unless it is -1 or -2 the heart rate
    becomes -3.
    """
    hit = last_before(hr, pr, [key], ["value"], within, inclusive=True, open_lookback=True)
    pulse = F.col("match.value")
    keep = pulse.isNull() | pulse.isin(-1.0, -2.0)
    return hit.withColumn("value", F.when(keep, F.col("value")).otherwise(F.lit(-3.0))).drop("match")


def step_value(
    samples: DataFrame,
    settings: DataFrame,
    keys,
    column: str,
    default: float,
    axis: str = "sn",
) -> DataFrame:
    """Setting in force at each sample; a setting applies strictly after its sn."""
    hit = last_before(samples, settings, keys, [column], axis=axis)
    return hit.withColumn(column, F.coalesce(F.col(f"match.{column}"), F.lit(default))).drop("match")


def activity_grid(
    accelerometers: dict[str, DataFrame],
    posture: DataFrame,
    keys=("session", "block"),
    step: int = 10,
    missing: float = 32768.0,
) -> DataFrame:
    """Accelerometers and posture on one tick grid.

    The grid runs from the latest first sample to the earliest last sample.
    Each accelerometer gives its next sample at or after the tick, posture the
    next one after it that is less than ``step`` ticks away.
    """
    spans = None
    for name, acc in accelerometers.items():
        s = acc.groupBy(*keys).agg(F.min("sn").alias(f"_lo_{name}"), F.max("sn").alias(f"_hi_{name}"))
        spans = s if spans is None else spans.join(s, list(keys))
    lows = [f"_lo_{n}" for n in accelerometers]
    highs = [f"_hi_{n}" for n in accelerometers]
    lo, hi = (F.greatest(*lows), F.least(*highs)) if len(lows) > 1 else (F.col(lows[0]), F.col(highs[0]))
    ticks = spans.where(lo < hi).select(
        *keys, F.explode(F.sequence(lo, hi - 1, F.lit(step).cast("bigint"))).alias("sn")
    )
    for name, acc in accelerometers.items():
        cols = [c for c in acc.columns if c in ("x", "y", "z", "value")]
        ticks = first_after(ticks, acc, keys, cols, inclusive=True, axis="sn")
        ticks = ticks.select(
            *[c for c in ticks.columns if c != "match"],
            *[F.coalesce(F.col(f"match.{c}"), F.lit(missing)).alias(f"{name}_{c}") for c in cols],
        )
    cols = [c for c in posture.columns if c in ("pos1", "pos2", "value")]
    ticks = first_after(ticks, posture, keys, cols, ahead=step, axis="sn")
    return ticks.select(
        *[c for c in ticks.columns if c != "match"],
        *[F.coalesce(F.col(f"match.{c}"), F.lit(missing)).alias(f"posture_{c}") for c in cols],
    )


SECONDS_PER_TICK = 0.002


def sync_segments(anchors: DataFrame, keys=("session", "block")) -> DataFrame:
    """Anchors with the slope to the next one; a sync after a reset is left out.

    ``anchors`` has (keys, seq, sn, t) in arrival order ``seq``.  When the last
    sync has a lower sequence number than the first it belongs to the next
    stretch.
    """
    ends = anchors.groupBy(*keys).agg(
        F.min_by("sn", "seq").alias("_first"),
        F.max_by("sn", "seq").alias("_last"),
        F.max("seq").alias("_end"),
    )
    a = anchors.join(ends, list(keys)).where(
        (F.col("seq") != F.col("_end")) | (F.col("_last") >= F.col("_first"))
    )
    a = scan(
        balance(a.drop("_first", "_last", "_end"), keys, "sn", balance(anchors, keys, "sn")),
        keys,
        ["sn", "seq"],
        _sn=slices.following("sn"),
        _t=slices.following("t"),
    )
    slope = F.when(
        F.col("_sn") > F.col("sn"), (F.col("_t") - F.col("t")) / (F.col("_sn") - F.col("sn"))
    ).otherwise(F.lit(SECONDS_PER_TICK))
    return unsliced(a).select(*keys, "seq", "sn", "t", slope.alias("slope"))


def with_time(
    readings: DataFrame,
    anchors: DataFrame,
    keys=("session", "block"),
    lead_in: float | None = 30.0,
) -> DataFrame:
    """Give every reading its time from the sync anchors.

    Straight lines between anchors, 2 ms per tick outside them.  Rows more
    than ``lead_in`` seconds before the first anchor are dropped; without any
    anchor the time is 2 ms per tick from zero.
    """
    segments = sync_segments(anchors, keys).select(
        *keys, "seq", "sn", "slope", F.col("t").alias("t0"), F.col("sn").alias("sn0")
    )
    rows = readings.select(*keys, "sn").unionByName(anchors.select(*keys, "sn"))
    checked = balance(rows, keys, "sn")
    df = _stack(readings, segments, keys, ["t0", "sn0", "slope"], "sn", "seq", True, checked)
    df = scan(
        df,
        keys,
        ["_t", "_side", "_seq"],
        _before=filled("_r"),
        _after=refilled_after("_r"),
    )
    sn = F.col("_t")
    inside = F.col("_before.t0") + (sn - F.col("_before.sn0")) * F.col("_before.slope")
    lead = F.col("_after.t0") + (sn - F.col("_after.sn0")) * SECONDS_PER_TICK
    free = sn * 2 / 1000.0
    out = df.where(F.col("_l").isNotNull()).withColumn("_time", F.coalesce(inside, lead, free))
    if lead_in is not None:
        # before the first anchor the time is lead = t0 - (sn0 - sn) * 2 ms
        early = F.col("_before").isNull() & F.col("_after").isNotNull()
        out = out.where(~(early & (F.col("_time") <= F.col("_after.t0") - lead_in)))
    return out.select("_l.*", F.col("_time").alias("t"))


def with_sequence(
    rows: DataFrame, anchors: DataFrame, keys=("session", "block"), bounds: DataFrame | None = None
) -> DataFrame:
    """Sequence number of timestamped rows: the inverse of the time axis.

    Clamped to the anchors, rounded half to even; rows outside the block's
    ``bounds`` (keys, min_sn, max_sn) are dropped.
    """
    segments = sync_segments(anchors, keys).select(
        *keys, "seq", "t", "slope", F.col("t").alias("t0"), F.col("sn").alias("sn0")
    )
    both = rows.select(*keys, "t").unionByName(anchors.select(*keys, "t"))
    checked = balance(both, keys, "t")
    segments = balance(segments, keys, "t", checked)
    segments = unsliced(scan(segments, keys, ["t", "seq"], sn1=slices.following("sn0")))
    df = _stack(rows, segments, keys, ["t0", "sn0", "sn1", "slope"], "t", "seq", True, checked)
    df = scan(
        df, keys, ["_t", "_side", "_seq"], _before=filled("_r"), _after=refilled_after("_r")
    )
    sn = F.when(
        F.col("_before").isNull(), F.col("_after.sn0")
    ).when(
        F.col("_before.sn1").isNull(), F.col("_before.sn0")
    ).otherwise(F.col("_before.sn0") + (F.col("_t") - F.col("_before.t0")) / F.col("_before.slope"))
    out = df.where(F.col("_l").isNotNull()).select("_l.*", F.rint(sn).cast("bigint").alias("sn"))
    if bounds is not None:
        out = out.join(bounds, list(keys)).where("sn between min_sn and max_sn").drop("min_sn", "max_sn")
    return out
