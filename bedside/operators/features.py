"""Rhythm features of sample windows (one array column per window)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import slices
from .slices import balance, following, previous, scan, unsliced

# ---- built from array functions -------------------------------------------------


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))


def mean(a: Column) -> Column:
    return F.try_divide(total(a), F.size(a))


def kurtosis(a: Column) -> Column:
    """Population kurtosis (3 for a normal sample).

    The mean travels in the accumulator, so it is worked out once per window.
    """
    zero = F.struct(mean(a).alias("m"), F.lit(0.0).alias("s2"), F.lit(0.0).alias("s4"))

    def step(s, x):
        d2 = (x.cast("double") - s["m"]) * (x.cast("double") - s["m"])
        return F.struct(s["m"].alias("m"), (s["s2"] + d2).alias("s2"), (s["s4"] + d2 * d2).alias("s4"))

    return F.aggregate(
        a, zero, step, lambda s: F.try_divide(s["s4"] * F.size(a), s["s2"] * s["s2"])
    )


def variability(rr: Column) -> Column:
    """Root mean square of successive differences over the mean interval.

    ``rr`` are the intervals; the divisor is one less than the differences.
    """
    n = F.size(rr)
    diff = F.zip_with(
        F.slice(rr, F.lit(2), n - 1), F.slice(rr, F.lit(1), n - 1), lambda b, a: b - a
    )
    squares = total(F.transform(diff, lambda d: d * d))
    return F.when(n > 2, F.try_divide(F.sqrt(F.try_divide(squares, n - 2)), mean(rr)))


def turning_points(rr: Column) -> Column:
    """Strict local extremes of a sequence."""
    n = F.size(rr)
    inner = F.sequence(F.lit(1), n - 2)
    at = lambda i: F.get(rr, i)
    is_turn = lambda i: (
        ((at(i) > at(i - 1)) & (at(i) > at(i + 1))) | ((at(i) < at(i - 1)) & (at(i) < at(i + 1)))
    )
    return F.when(n > 2, F.size(F.filter(inner, is_turn))).otherwise(F.lit(0))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two equally long windows, else -1."""
    dot = total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    norm = lambda v: F.sqrt(total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))
    same = F.size(a) == F.size(b)
    return F.when(same, F.try_divide(dot, norm(a) * norm(b))).otherwise(F.lit(-1.0))


def leakage(a: Column) -> Column:
    """Leakage: sum of the signal and itself half a period on, over magnitudes.

    The mean period is 2*pi*sum|x| / sum|dx|, the first sum leaving out both
    ends; half of it is rounded half to even.
    """
    n = F.size(a)
    inner = total(F.transform(F.slice(a, F.lit(2), F.greatest(n - 2, F.lit(0))), lambda x: F.abs(x.cast("double"))))
    step = F.zip_with(
        F.slice(a, F.lit(2), n - 1),
        F.slice(a, F.lit(1), n - 1),
        lambda y, x: F.abs(y.cast("double") - x.cast("double")),
    )
    period = F.try_divide(F.lit(2.0 * 3.14159265) * inner, total(step))
    half = F.rint(period / 2).cast("int")
    late = F.slice(a, half + 1, F.greatest(n - half, F.lit(0)))
    early = F.slice(a, F.lit(1), F.greatest(n - half, F.lit(0)))
    both = F.zip_with(late, early, lambda y, x: F.abs(y.cast("double") + x.cast("double")))
    size = F.zip_with(
        late, early, lambda y, x: F.abs(y.cast("double")) + F.abs(x.cast("double"))
    )
    return F.when(half < n, F.try_divide(total(both), total(size)))


# ---- row features -----------------------------------------------------------------


def interval_differences(beats: DataFrame, keys=("session",), order=("t", "seq")) -> DataFrame:
    """Beats with the change of interval and whether they are a turning point."""
    df = scan(
        balance(beats, keys, order[0]), keys, order, _a=previous("rr"), _b=following("rr")
    )
    rr, a, b = F.col("rr"), F.col("_a"), F.col("_b")
    turn = ((rr > a) & (rr > b)) | ((rr < a) & (rr < b))
    return unsliced(
        df.withColumn("drr", F.coalesce(rr - a, F.lit(0.0))).withColumn(
            "turn", F.coalesce(turn, F.lit(False)).cast("int")
        )
    ).drop("_a", "_b")


def beat_similarity(
    beats: DataFrame, samples: DataFrame, keys=("session", "block"), radius: int = 20, least: float = 0.6
) -> DataFrame:
    """Cosine similarity of the waveform around consecutive beats, and the screen.

    The window reaches ``radius`` samples back and ``radius`` - 1 on.  A beat
    without a sample at its own sequence number has no similarity and fails.
    """
    from .slices import running_sum

    checked = balance(samples, keys, "sn")
    numbered = scan(checked, keys, ["sn"], _pos=running_sum(F.lit(1)))
    numbered = unsliced(numbered).select(*keys, "sn", "_pos", "value")
    at = beats.select(*keys, "sn").distinct().join(numbered.drop("value"), [*keys, "sn"])
    width = 2 * radius
    lo, hi = F.col("_m") - radius, F.col("_m") + radius - 1
    at = at.withColumnRenamed("_pos", "_m").where(F.col("_m") > radius + 1)
    spread = at.withColumn("_bucket", F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width))))
    near = (
        numbered.drop("sn")
        .withColumn("_bucket", F.floor(F.col("_pos") / width))
        .join(spread, [*keys, "_bucket"])
        .where((F.col("_pos") >= lo) & (F.col("_pos") <= hi))
    )
    shape = near.groupBy(*keys, "sn").agg(
        F.sort_array(F.collect_list(F.struct("_pos", "value"))).alias("_w")
    ).select(*keys, "sn", F.col("_w.value").alias("_w"))
    df = beats.join(shape, [*keys, "sn"], "left")
    df = scan(balance(df, keys, "sn"), keys, ["sn"], _before=previous("_w"))
    sim = F.when(F.col("_w").isNotNull() & F.col("_before").isNotNull(), cosine(F.col("_before"), F.col("_w")))
    return (
        unsliced(df.withColumn("similarity", sim))
        .withColumn("good", F.coalesce(F.col("similarity") >= least, F.lit(False)).cast("int"))
        .drop("_w", "_before")
    )


# ---- window features that need pairs or recursion: numpy per window ------------------


def _neighbours(points: np.ndarray, r: float) -> np.ndarray:
    """For each row of ``points`` the other rows nearer than ``r`` in the largest coordinate.

    A k-d tree against itself: pairs of nodes whose boxes lie wholly within
    ``r`` add their sizes without looking at points, pairs wholly beyond it go,
    the rest is divided down to leaves of ``LEAF`` points.  Pairs wait on a
    stack and are taken ``AT_ONCE`` at a time, so memory grows with the points
    only.  Rounding keeps order, so box bounds decide exactly as points would.
    """
    counts = np.zeros(len(points), dtype=np.int64)
    known = np.flatnonzero(np.isfinite(points).all(axis=1))
    if not r > 0 or len(known) < 2:
        return counts
    depth = 0 if len(known) <= DIRECT else math.ceil(math.log2(len(known) / LEAF))
    # halves of halves along the widest side; nodes of one depth differ by a point at most
    order, starts = known, np.array([0, len(known)])
    lows, highs, firsts, sizes = [], [], [], []
    for level in range(depth + 1):
        size = np.diff(starts)
        sorted_points = points[order]
        low = np.minimum.reduceat(sorted_points, starts[:-1])
        high = np.maximum.reduceat(sorted_points, starts[:-1])
        lows.append(low), highs.append(high), firsts.append(starts[:-1]), sizes.append(size)
        if level < depth:
            node = np.repeat(np.arange(len(size)), size)
            side = np.argmax(high - low, axis=1)[node]
            order = order[np.lexsort((sorted_points[np.arange(len(order)), side], node))]
            cuts = np.empty(2 * len(size) + 1, dtype=np.int64)
            cuts[::2], cuts[1::2] = starts, starts[:-1] + size // 2
            starts = cuts
    # boxes hold for the points of a node, whichever way the levels below order them
    flat = points[order]
    inside = [np.zeros(len(s), dtype=np.int64) for s in sizes]
    own = np.zeros(len(flat), dtype=np.int64)
    offsets = np.arange(int(sizes[depth].max()))
    todo = [(0, np.array([0]), np.array([0]))]
    while todo:
        level, a, b = todo.pop()
        if len(a) > AT_ONCE:
            todo.append((level, a[AT_ONCE:], b[AT_ONCE:]))
            a, b = a[:AT_ONCE], b[:AT_ONCE]
        up = highs[level][a] - lows[level][b]
        down = highs[level][b] - lows[level][a]
        gap = -np.minimum(up, down).min(axis=1)
        reach = np.maximum(up, down).max(axis=1)
        whole = reach < r
        np.add.at(inside[level], a[whole], sizes[level][b[whole]])
        rest = ~whole & (gap < r)
        a, b = a[rest], b[rest]
        if not len(a):
            continue
        if level < depth:
            a, b = 2 * a, 2 * b
            todo.append((level + 1, np.r_[a, a, a + 1, a + 1], np.r_[b, b + 1, b, b + 1]))
            continue
        rows = firsts[level][a][:, None] + offsets
        cols = firsts[level][b][:, None] + offsets
        is_row, is_col = offsets < sizes[level][a][:, None], offsets < sizes[level][b][:, None]
        rows, cols = np.where(is_row, rows, 0), np.where(is_col, cols, 0)
        near = is_row[:, :, None] & is_col[:, None, :]
        for k in range(flat.shape[1]):
            near &= np.abs(flat[rows, k][:, :, None] - flat[cols, k][:, None, :]) < r
        np.add.at(own, rows[is_row], near.sum(axis=2)[is_row])
    for level in range(depth + 1):
        own += np.repeat(inside[level], sizes[level])
    counts[order] = own - 1  # each point met itself
    return counts


DIRECT, LEAF, AT_ONCE = 128, 16, 4096  # points without a tree, points of a leaf, node pairs looked at together


def _sample_entropy(x: np.ndarray, dim: int = 2, scale: float = 0.2) -> float:
    """ln of template matches of length ``dim`` over those one longer."""
    n = len(x)
    m = n - dim
    if m < 2:
        return math.nan
    r = scale * np.std(x)
    templates = np.lib.stride_tricks.sliding_window_view(x, dim + 1)
    short = int(_neighbours(templates[:, :dim], r).sum()) // 2
    long_ = int(_neighbours(templates, r).sum()) // 2
    return math.log(short / long_) if long_ else math.nan


def _sample_entropies(windows, dim: int = 2, scale: float = 0.2) -> list[float]:
    """:func:`_sample_entropy` of many windows; short ones of equal length are taken together."""
    out = [math.nan] * len(windows)
    alike: dict[int, list[int]] = {}
    for i, w in enumerate(windows):
        alike.setdefault(len(w), []).append(i)
    for n, places in alike.items():
        m = n - dim
        if n > DIRECT:
            for i in places:
                out[i] = _sample_entropy(np.asarray(windows[i], dtype=float), dim, scale)
        if m < 2 or n > DIRECT:
            continue
        upper = np.triu_indices(m, 1)
        at_once = max(1, PAIRS // len(upper[0]))
        for k in range(0, len(places), at_once):
            part = places[k : k + at_once]
            x = np.concatenate([np.asarray(windows[i], dtype=float) for i in part]).reshape(len(part), n)
            r = scale * np.std(x, axis=1)[:, None]
            near = np.ones((len(part), len(upper[0])), dtype=bool)
            for d in range(dim + 1):
                if d == dim:
                    short = near.sum(axis=1)
                near &= np.abs(x[:, upper[0] + d] - x[:, upper[1] + d]) < r
            for i, a, b in zip(part, short.tolist(), near.sum(axis=1).tolist()):
                out[i] = math.log(a / b) if b else math.nan
    return out


PAIRS = 1_000_000  # pairs of templates looked at together


def _entropy_profile(x: np.ndarray, longest: int, r: float, normalise: bool):
    """Entropy and standard error for template lengths 0 to ``longest``.

    The error follows the published variance of the match probability: pairs of
    matching templates that overlap are counted as dependent.  Matches are
    counted per template in a tree, and pairs of near templates from diagonals.
    """
    n = len(x)
    top = longest + 1
    if n < 2 * top:
        return []
    if normalise:
        sd = np.std(x)
        x = (x - np.mean(x)) / sd if sd else x - np.mean(x)
    counts, touching, before = [], np.zeros((top, top + 1)), None
    for m in range(top):
        # matches of m + 1 points that end at each sample
        degree = np.zeros(n, dtype=np.int64)
        degree[m:] = _neighbours(np.lib.stride_tricks.sliding_window_view(x, m + 1), r)
        a = int(degree.sum()) // 2
        # matches among templates that may still be extended: the last point is left out
        b = n * (n - 1) / 2.0 if m == 0 else float(int(before.sum()) // 2 - before[n - 1])
        counts.append((m, a, b, a / b if b else math.nan))
        touching[m] = _dependent(degree.astype(float), lambda d, m=m: _diagonal(x, r, m, d), top)
        before = degree
    return _with_errors(counts, touching, n)


def _diagonal(x: np.ndarray, r: float, m: int, d: int) -> np.ndarray:
    """Whether the last m + 1 points match, for all pairs of samples ``d`` apart."""
    close = np.abs(x[d:] - x[:-d]) < r
    match = np.zeros(len(close), dtype=bool)
    if len(close) > m:
        match[m:] = np.lib.stride_tricks.sliding_window_view(close, m + 1).all(axis=1)
    return match


def _with_errors(counts, touching, n):
    """Attach the standard error to each template length.

    The variance of a match probability p over b pairs is p(1-p)/b plus
    (K_long - K_short p^2)/b^2, where K counts pairs of matches that depend on
    each other because their templates overlap.
    """
    rows = []
    for m, a, b, p in counts:
        if not b or not a:
            rows.append((m, None, None))
            continue
        long_ = touching[m, : m + 1].sum()
        short = touching[m - 1, : m + 1].sum() if m else n * (n - 1.0) * (n - 2.0)
        extra = (long_ - short * p * p) / (b * b)
        rows.append((m, -math.log(p), math.sqrt(p * (1.0 - p) / b + max(extra, 0.0))))
    return rows


def _dependent(degree, diagonal, top):
    """Dependent pairs by distance 0, 1, ... of the two templates.

    At distance d > 0 the matches of both are multiplied, leaving out those
    with templates so near that they are already counted.
    """
    n = len(degree)
    out = np.zeros(top + 1)
    out[0] = (degree * (degree - 1)).sum()
    before, after = degree.copy(), degree.copy()
    reach = 0
    for d in range(1, top):
        while reach < 2 * d:
            reach += 1
            near = diagonal(reach)
            before[reach:] -= near
            if reach < 2 * d:
                after[: n - reach] -= near
        out[d] = 2.0 * (before[d:] * after[: n - d]).sum()
        after[: n - reach] -= diagonal(reach)
    return out


def _band_coefficients(low: float, high: float, rate: float):
    """First-order Butterworth band-pass by the bilinear transform."""
    w1, w2 = (2 * rate * math.tan(math.pi * f / rate) for f in (low, high))
    width, centre = w2 - w1, w1 * w2
    c = 2 * rate
    a0 = c * c + width * c + centre
    b = np.array([width * c, 0.0, -width * c]) / a0
    a = np.array([a0, 2 * centre - 2 * c * c, c * c - width * c + centre]) / a0
    return b, a


def _filtered(x: np.ndarray, b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Second-order recursion over the columns of ``x`` (one window per row)."""
    y = np.zeros_like(x, dtype=float)
    s1 = np.zeros(x.shape[0])
    s2 = np.zeros(x.shape[0])
    for i in range(x.shape[1]):
        y[:, i] = b[0] * x[:, i] + s1
        s1 = b[1] * x[:, i] - a[1] * y[:, i] + s2
        s2 = b[2] * x[:, i] - a[2] * y[:, i]
    return y


def _band_count(x: np.ndarray, rate: float = 125.0) -> int:
    """Filtered samples above the mean magnitude in eight equal stretches.

    The last sample of each stretch is left out.
    """
    b, a = _band_coefficients(13.0, 16.5, rate)
    y = np.abs(_filtered(x[None, :], b, a)[0])
    width = len(y) // 8
    count = 0
    for i in range(8):
        part = y[i * width : (i + 1) * width - 1]
        if len(part):
            count += int((part > part.mean()).sum())
    return count


def _crossing_share(x: np.ndarray, rate: int, threshold: float = 0.2) -> float:
    """Percent of samples over the threshold, averaged over 3 s windows each second."""
    width = 3 * rate
    count = int(np.round((len(x) - width) / rate)) + 1
    if count < 1:
        return math.nan
    x = x - x.mean()
    if not x.max() > 0:
        return math.nan
    over = np.r_[0, np.cumsum(np.abs(x / x.max()) > threshold)]
    starts = np.arange(count) * rate
    stops = np.minimum(starts + width - 1, len(x))
    return float(np.mean((over[stops] - over[starts]) * (100.0 / width)))


def crossing_share(window: Column, rate: int = 125, threshold: float = 0.2) -> Column:
    """Threshold-crossing sample count in percent, over 3 s windows every second.

    The mean is removed and the maximum scaled to one; each window counts its
    samples (but the last) whose magnitude passes the threshold.
    """

    @F.pandas_udf("double")
    def share(windows: pd.Series) -> pd.Series:
        out = [_crossing_share(np.asarray(w, dtype=float), rate, threshold) for w in windows]
        return pd.Series(out, dtype="float64")

    return F.nanvl(share(window), F.lit(None).cast("double"))


def sample_entropy(window: Column, dim: int = 2, scale: float = 0.2, none: float | None = None) -> Column:
    """Sample entropy of a window; ``none`` stands for a window without matches."""

    @F.pandas_udf("double")
    def entropy(windows: pd.Series) -> pd.Series:
        out = _sample_entropies(windows.tolist(), dim, scale)
        return pd.Series([None if math.isnan(v) else v for v in out], dtype="float64")

    found = F.nanvl(entropy(window), F.lit(None).cast("double"))
    return found if none is None else F.coalesce(found, F.lit(float(none)))


def entropy_profile(window: Column, longest: int = 2, r: float = 0.2, normalise: bool = False) -> Column:
    """Array of (length, entropy, error) for template lengths 0 to ``longest``."""

    @F.pandas_udf("array<struct<length:int,entropy:double,error:double>>")
    def profile(windows: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [
                    {"length": m, "entropy": e, "error": s}
                    for m, e, s in _entropy_profile(np.asarray(w, dtype=float), longest, r, normalise)
                ]
                for w in windows
            ]
        )

    return profile(window)


def band_count(window: Column, rate: float = 125.0) -> Column:
    @F.pandas_udf("int")
    def count(windows: pd.Series) -> pd.Series:
        return pd.Series([_band_count(np.asarray(w, dtype=float), rate) for w in windows])

    return count(window)


ECG_STEP = 4.76837158203125e-05
ECG_LIMIT = 10.0 / ECG_STEP


def fibrillation_features(window: Column, rate: int = 125) -> Column:
    """Peak, band count, crossing share, leakage and entropy of a lead.

    Windows at or above 10 mV, flat ones and empty ones give -1 for each.
    """
    peak = F.array_max(F.transform(window, lambda x: F.abs(x.cast("double"))))
    use = F.coalesce((peak < ECG_LIMIT) & (peak > 0), F.lit(False))
    gate = lambda c: F.when(use, F.coalesce(c, F.lit(-1.0))).otherwise(F.lit(-1.0))
    return F.struct(
        F.coalesce(peak, F.lit(-1.0)).alias("peak"),
        gate(band_count(window, rate).cast("double")).alias("band_count"),
        gate(crossing_share(window, rate)).alias("crossing"),
        gate(leakage(window)).alias("leakage"),
        gate(sample_entropy(window)).alias("entropy"),
    )


# ---- atrial fibrillation decision -----------------------------------------------------

FIBRILLATION, NO_RHYTHM, INVALID, POOR_SIGNAL = 1, 0, -1, -2


def rhythm_features(
    windows: DataFrame,
    heart_rate: DataFrame,
    beats_needed: int,
    update_seconds: float = 30.0,
    longest_gap: float = 5.0,
    keys=("session",),
) -> DataFrame:
    """Entropy and variability per update, and the code where a rule already fixes it.

    ``windows`` has (keys, update, stop, ts, rr, good, leads): the beats in
    reach of each update as arrays in time order.  ``fixed`` is invalid without
    beats, with leads off, with more than five seconds of heart rate missing, or
    when the newest beat is stale; poor signal with too few good beats; null
    where a classifier has to decide.  ``start`` is the oldest beat in reach.
    """
    w = windows.withColumn("_t0", F.array_min("ts")).withColumn("_t1", F.array_max("ts"))
    w = _seen(w, heart_rate, keys)
    n = F.lit(beats_needed)
    tagged = F.arrays_zip(F.col("rr").alias("rr"), F.col("drr").alias("drr"), F.col("good").alias("good"))
    good = F.filter(tagged, lambda b: b["good"] > 0)
    w = w.withColumn("_good", good)
    last = F.slice("_good", F.greatest(F.size("_good") - n + 1, F.lit(1)), n)
    w = w.withColumn("_rr", F.transform(last, lambda b: b["rr"])).withColumn(
        "_drr", F.transform(last, lambda b: b["drr"])
    )
    squares = total(F.transform("_drr", lambda d: d * d))
    w = w.withColumn("entropy", sample_entropy(F.col("_drr")))
    w = w.withColumn("variability", F.try_divide(F.sqrt(F.try_divide(squares, F.size("_drr") - 1)), mean(F.col("_rr"))))
    invalid = (
        F.col("_t1").isNull()
        | F.exists("leads", lambda x: x == 0)
        | ((F.col("_t1") - F.col("_t0") - F.col("_seen")) > longest_gap)
        | (F.col("stop") - F.col("_t1") > update_seconds)
    )
    fixed = (
        F.when(F.coalesce(invalid, F.lit(True)), INVALID)
        .when(F.size("rr") < n, NO_RHYTHM)
        .when(F.size("_good") < n, POOR_SIGNAL)
        .when(~F.coalesce(F.col("variability") > 0, F.lit(False)), INVALID)
    )
    return w.select(*keys, "update", F.col("_t0").alias("start"), "stop", fixed.alias("fixed"), "entropy", "variability")


def _seen(w: DataFrame, heart_rate: DataFrame, keys) -> DataFrame:
    """Updates with the readings from ``_t0`` to ``_t1`` as ``_seen``.

    Both ends go through one scan among the readings and are apart by the
    readings counted up to each, so no reading meets the updates it counts for.
    """
    begin, reading, end = 0, 1, 2  # at one time in this order: both ends count
    none = F.lit(None).cast(w.select(F.struct(*w.columns).alias("_w")).schema["_w"].dataType)
    ends = F.array(
        F.struct(F.col("_t0").alias("t"), F.lit(begin).alias("_kind"), none.alias("_w")),
        F.struct(F.col("_t1").alias("t"), F.lit(end).alias("_kind"), F.struct(*w.columns).alias("_w")),
    )
    rows = w.select(*keys, "update", F.explode(ends).alias("_e")).select(*keys, "update", "_e.*")
    rows = rows.unionByName(heart_rate.select(*keys, "t", F.lit(reading).alias("_kind")).dropna(), allowMissingColumns=True)
    count = slices.running_sum((F.col("_kind") == reading).cast("bigint"))
    rows = unsliced(scan(balance(rows, keys, "t"), keys, ["t", "_kind", "update"], _count=count))
    both = rows.where(F.col("_kind") != reading).groupBy(*keys, "update").agg(
        F.collect_list("_w").alias("_w"), F.sum(F.when(F.col("_kind") == end, F.col("_count")).otherwise(-F.col("_count"))).alias("_seen")
    )
    return both.select(F.explode("_w").alias("_w"), "_seen").select("_w.*", "_seen")


def rhythm_updates(
    windows: DataFrame,
    heart_rate: DataFrame,
    beats_needed: int,
    centre: tuple[float, float],
    scale: tuple[float, float],
    score,
    update_seconds: float = 30.0,
    longest_gap: float = 5.0,
    keys=("session",),
    no_entropy: float | None = None,
) -> DataFrame:
    """Rhythm code per update and the start of the stretch it belongs to.

    Where no rule of ``rhythm_features`` fixes the code, the z-scored entropy and
    variability of the last beats go to ``score``, a function from two columns to a
    boolean column (such as a trained ``plans.rhythm_model.RhythmModel``).
    An entropy that is missing goes as null, or as ``no_entropy`` if given.
    """
    w = rhythm_features(windows, heart_rate, beats_needed, update_seconds, longest_gap, keys)
    entropy = F.col("entropy") if no_entropy is None else F.coalesce("entropy", F.lit(float(no_entropy)))
    z0 = (entropy - centre[0]) / scale[0]
    z1 = (F.col("variability") - centre[1]) / scale[1]
    decided = F.when(F.coalesce(score(z0, z1), F.lit(False)), FIBRILLATION).otherwise(NO_RHYTHM)
    code = F.coalesce("fixed", decided)
    w = w.select(*keys, "update", "stop", code.alias("code"), "entropy", "variability")
    w = scan(balance(w, keys, "update"), keys, ["update"], _was=previous("code"))
    start = F.when(F.col("code").eqNullSafe(F.col("_was")), None).otherwise(F.col("stop"))
    w = scan(w.withColumn("_start", start), keys, ["update"], rhythm_start=slices.filled("_start"))
    return unsliced(w).drop("_was", "_start")
