"""Waveform packets, leads, windows and noise spikes.

Everything is keyed by (session, block): a block is at most three hours of
samples, which bounds the ordered windows below.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import NO_SAMPLE, TICKS_PER_SECOND
from ..session import durable

BLOCK = ("session", "block")
RAIL = 2**23 - 32


def explode_samples(packets: DataFrame, channels: list[str] | None = None) -> DataFrame:
    """Packets to one row per tick.

    Sample i sits ``i * 500 / sample_rate`` ticks after the packet.  Packets
    with several channels interleave them; ``channels`` names the columns.
    """
    names = channels or ["value"]
    n = len(names)
    spp = F.floor(F.lit(TICKS_PER_SECOND) / F.col("sample_rate")).cast("bigint")
    steps = F.sequence(F.lit(0), F.floor(F.size("samples") / n).cast("int") - 1)
    row = F.transform(
        steps,
        lambda i: F.struct(
            (F.col("sn") + i * spp).alias("sn"),
            *[F.get("samples", i * n + c).alias(name) for c, name in enumerate(names)],
        ),
    )
    rest = [c for c in packets.columns if c not in ("sn", "samples", "sample_rate", "channels")]
    return (
        packets.where(F.size("samples") >= n)
        .select(*rest, F.explode(row).alias("_s"))
        .select(*rest, "_s.*")
    )


def leads_long(wide: DataFrame, leads: list[str], keys=BLOCK) -> DataFrame:
    """Wide lead columns to (lead, value) rows without the missing samples."""
    return wide.unpivot([*keys, "sn"], leads, "lead", "value").where(F.col("value") != NO_SAMPLE)


def leads_wide(
    samples: DataFrame,
    leads: list[str],
    keys=BLOCK,
    missing: float = NO_SAMPLE,
    dense: bool = True,
    max_ticks: int | None = None,
    step: int = 1,
) -> DataFrame:
    """Leads on one sequence grid; the first sample of a duplicate wins.

    ``dense`` fills every tick between the first and last sample, missing
    values with the sentinel; a block longer than ``max_ticks`` is left out.
    """
    wide = samples.groupBy(*keys, "sn").agg(
        *[F.min_by(F.when(F.col("lead") == n, F.col("value")), F.when(F.col("lead") == n, F.col("seq"))).alias(n) for n in leads]
    )
    if dense:
        grid = tick_grid(samples, keys, max_ticks, step)
        wide = grid.join(wide, [*keys, "sn"], "left")
    return wide.select(*keys, "sn", *[F.coalesce(n, F.lit(missing)).alias(n) for n in leads])


def tick_grid(samples: DataFrame, keys=BLOCK, max_ticks: int | None = None, step: int = 1) -> DataFrame:
    """Every tick between the first and last sample of a block, in strips so that no array holds a whole block.

    A block longer than ``max_ticks`` is left out.
    """
    span = samples.groupBy(*keys).agg(F.min("sn").alias("_lo"), F.max("sn").alias("_hi"))
    if max_ticks is not None:
        span = span.where(F.col("_hi") - F.col("_lo") <= max_ticks)
    strips = span.select(
        *keys, "_hi", F.explode(F.sequence("_lo", "_hi", F.lit(10_000 * step).cast("bigint"))).alias("_s")
    )
    last = F.least(F.col("_s") + (10_000 * step - 1), "_hi")
    return strips.select(*keys, F.explode(F.sequence("_s", last, F.lit(step).cast("bigint"))).alias("sn"))


def clipped(value: Column, rail: int = RAIL, code: int = RAIL) -> Column:
    """Samples at or beyond either rail become the missing code."""
    return F.when((value >= rail) | (value <= -rail), F.lit(code)).otherwise(value)


def merged_ecg(samples: DataFrame, leads: list[str], keys=BLOCK) -> DataFrame:
    """Leads merged on the tick grid, clipped at the rails."""
    wide = leads_wide(samples, leads, keys, missing=RAIL)
    return wide.select(*keys, "sn", *[clipped(F.col(n)).alias(n) for n in leads])


def fixed_windows(samples: DataFrame, ticks: int = 4096, every: int = 4, keys=BLOCK) -> DataFrame:
    """Whole windows of ``ticks`` with decimated samples in order.

    Windows start at the block's first kept sample; a partial tail is left out.
    """
    kept = samples.where(F.col("sn") % every == 0)
    span = kept.groupBy(*keys).agg(F.min("sn").alias("_sn0"), F.max("sn").alias("_sn1"))
    index = F.floor((F.col("sn") - F.col("_sn0")) / ticks)
    rows = kept.join(span, list(keys)).withColumn("_w", index)
    rows = rows.where(F.col("_w") < F.floor((F.col("_sn1") - F.col("_sn0")) / ticks))
    out = rows.groupBy(*keys, "_sn0", "_w").agg(
        F.sort_array(F.collect_list(F.struct("sn", "value"))).alias("_a")
    )
    return out.select(
        *keys,
        (F.col("_sn0") + F.col("_w") * ticks).alias("start"),
        (F.col("_sn0") + (F.col("_w") + 1) * ticks).alias("stop"),
        F.col("_a.value").alias("samples"),
    )


def spike_density(
    spikes: DataFrame, blocks: DataFrame, seconds: int = 30, keys=BLOCK, at: str = "start_sn"
) -> DataFrame:
    """Spikes per second in each whole window (start, stop] of a block.

    ``blocks`` has (keys, sn_start, sn_stop); the partial tail is dropped.
    """
    ticks = seconds * TICKS_PER_SECOND
    # window edges are start, start+ticks, ... below the stop
    whole = F.ceil((F.col("sn_stop") - F.col("sn_start")) / ticks) - 1
    grid = blocks.where(whole > 0).select(
        *keys, "sn_start", F.explode(F.sequence(F.lit(1).cast("bigint"), whole)).alias("window")
    )
    hit = (
        spikes.join(blocks.select(*keys, "sn_start"), list(keys))
        .withColumn("window", F.ceil((F.col(at) - F.col("sn_start")) / ticks))
        .groupBy(*keys, "window")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return grid.join(hit, [*keys, "window"], "left").select(
        *keys,
        "window",
        (F.col("sn_start") + F.col("window") * ticks).alias("stop_sn"),
        (F.coalesce("_n", F.lit(0)) / F.lit(float(seconds))).alias("density"),
    )


def with_density(
    rows: DataFrame, density: DataFrame, blocks: DataFrame, seconds: int = 30, keys=BLOCK, at: str = "sn"
) -> DataFrame:
    """Each row with the spike density of its window; the first window gives 0."""
    ticks = seconds * TICKS_PER_SECOND
    d = density.where("window > 1").select(*keys, "window", "density")
    rows = rows.join(blocks.select(*keys, "sn_start"), list(keys)).withColumn(
        "window", F.ceil((F.col(at) - F.col("sn_start")) / ticks)
    )
    return (
        rows.join(d, [*keys, "window"], "left")
        .withColumn("density", F.coalesce("density", F.lit(0.0)))
        .drop("window", "sn_start")
    )


def radio_marks(filtered: DataFrame, keys=BLOCK) -> DataFrame:
    """Sequence numbers where the radio switches on (low bits 13)."""
    return filtered.where(F.pmod(F.col("value").cast("bigint"), F.lit(16)) == 13).select(*keys, "sn")


def at_marks(samples: DataFrame, marks: DataFrame, keys=BLOCK) -> DataFrame:
    return samples.join(marks.select(*keys, "sn").distinct(), [*keys, "sn"], "left_semi")


SPIKE_BEFORE, SPIKE_AFTER = 15, 127
SPIKE_AT = 16  # levels are measured from the sample after the mark
# Spike search window, neighbour radius and thresholds.
SPIKE_WINDOW, SPIKE_RADIUS, SPIKE_HEIGHT, SPIKE_SLOPE = 40, 6, 49, 29
STOP_FIRST, STOP_LAST = 11, 24


def mark_windows(
    samples: DataFrame, marks: DataFrame, keys=BLOCK, counts: DataFrame | None = None
) -> DataFrame:
    """The samples around each mark as two arrays (15 before to 127 after).

    Positions count samples, so samples are numbered within their block first.
    The first mark of a block and the last two are left out, as are marks whose
    neighbourhood is cut by an end of the block.  ``counts`` (keys, _marks) sets
    the number of marks the last two are counted from; default is their own.
    """
    cells = _mark_cells([samples], marks, keys)
    if counts is not None:
        cells = cells.drop("_marks").join(counts, list(keys))
    return _cell_windows(cells, keys).select(*keys, "mark_sn", "sns", "ppg")


CELL = SPIKE_AFTER + 1  # a window reaches into the cells next to that of its mark, no further


def _mark_cells(lights: list[DataFrame], marks: DataFrame, keys=BLOCK) -> DataFrame:
    """Samples of each light in cells of 128 positions, with the cells before and after and what marks they hold.

    Marks go through the scan among the samples and cells stay where their
    samples are, so every sample is shuffled once.  ``_upto`` counts the marks of
    the light up to the end of the cell, ``_marks`` those of the light of the
    block that has most.
    """
    from .slices import balance, filled, following, overall_max, previous, running_sum, scan, unsliced

    rows = marks.select(*keys, "sn", F.lit(-1).alias("_light")).dropna()
    for k, light in enumerate(lights):
        rows = rows.unionByName(light.select(*keys, "sn", "value", F.lit(k).alias("_light")), allowMissingColumns=True)
    checked = balance(rows, keys, "sn")
    # marks sort before the samples at their sequence number
    places = {f"_pos{k}": running_sum((F.col("_light") == k).cast("int")) for k in range(len(lights))}
    last = F.when(F.col("_light") < 0, F.col("sn"))
    numbered = unsliced(scan(checked, keys, ["sn", "_light"], _mark=filled(last), **places)).where("_light >= 0")
    pos = F.coalesce(*[F.when(F.col("_light") == k, F.col(f"_pos{k}")) for k in range(len(lights))])
    sample = F.struct(
        pos.alias("pos"), "sn", "value", F.coalesce(F.col("_mark") == F.col("sn"), F.lit(False)).alias("marked")
    )
    cells = numbered.groupBy(*keys, "_light", F.floor(pos / CELL).alias("_cell")).agg(
        F.sort_array(F.collect_list(sample)).alias("_a")
    )
    cells = cells.withColumn("_held", F.size(F.filter("_a", lambda x: x["marked"])))
    series = [*keys, "_light"]
    cells = scan(
        balance(cells, series, "_cell", reduced=checked), series, ["_cell"],
        _before=previous("_a"), _after=following("_a"), _upto=running_sum("_held"),
    )
    cells = unsliced(cells)
    most = balance(cells, keys, "_cell", reduced=checked)
    return unsliced(scan(most, keys, ["_cell", "_light"], _marks=overall_max("_upto")))


def _cell_windows(cells: DataFrame, keys=BLOCK, carrier: bool = False) -> DataFrame:
    """Windows of the marks of each cell; with ``carrier`` also a flat one (mark_sn null) per light of a block."""
    length = SPIKE_BEFORE + SPIKE_AFTER + 1
    none = F.slice("_a", 1, 0)
    before = F.coalesce(F.slice("_before", -SPIKE_BEFORE, SPIKE_BEFORE), none)
    after = F.coalesce("_after", none)
    # positions of the first and last sample at hand
    first = F.get("_a", F.lit(0))["pos"]
    cells = cells.withColumn("_lo", first - F.size(before)).withColumn("_hi", first + F.size("_a") + F.size(after) - 1)
    rank = F.col("_upto") - F.col("_held")

    def mark(x, i):
        at = (x["pos"] - first).cast("int")
        sn_before = F.coalesce(F.get("_a", at - 1)["sn"], F.get("_before", F.size("_before") - 1)["sn"])
        sn_after = F.coalesce(F.get("_a", at + 1)["sn"], F.get("_after", F.lit(0))["sn"])
        # a sequence number twice leaves open which sample is the mark
        twice = F.coalesce(sn_before == x["sn"], F.lit(False)) | F.coalesce(sn_after == x["sn"], F.lit(False))
        return F.struct((rank + i + 1).alias("rank"), x["pos"].alias("pos"), x["sn"].alias("sn"), twice.alias("twice"))

    def kept(m):
        whole = (m["pos"] - SPIKE_BEFORE >= F.col("_lo")) & (m["pos"] + SPIKE_AFTER <= F.col("_hi"))
        return (m["rank"] > 1) & (m["rank"] <= F.col("_marks") - 2) & whole & ~m["twice"]

    marks = F.filter(F.transform(F.filter("_a", lambda x: x["marked"]), mark), kept)
    marks = F.transform(marks, lambda m: F.struct(m["pos"].alias("pos"), m["sn"].alias("sn")))
    if carrier:
        nobody = F.struct(*[F.lit(None).cast("bigint").alias(n) for n in ("pos", "sn")])
        marks = F.when(F.col("_before").isNull(), F.concat(F.array(nobody), marks)).otherwise(marks)
    rows = cells.select(*keys, "_light", "_lo", F.concat(before, F.col("_a"), after).alias("_line"), F.explode(marks).alias("_m"))
    at = F.coalesce(F.col("_m.pos") - SPIKE_BEFORE - F.col("_lo") + 1, F.lit(1)).cast("int")
    rows = rows.select(*keys, "_light", F.col("_m.sn").alias("mark_sn"), F.slice("_line", at, length).alias("_w"))
    rows = rows.select(*keys, "_light", "mark_sn", F.col("_w.sn").alias("sns"), F.col("_w.value").alias("ppg"))
    if not carrier:
        return rows
    flat = lambda c: F.when(F.col("mark_sn").isNull(), F.array_repeat(F.lit(0), length)).otherwise(F.col(c)).alias(c)
    return rows.select(*keys, "_light", "mark_sn", flat("sns"), flat("ppg"))


def _measure(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each window (row) holds a spike, and where it peaks and stops."""
    rows = np.arange(len(v))
    at = np.arange(SPIKE_AT + 1, SPIKE_AT + SPIKE_WINDOW + 1)
    bend = (v[:, at + 1] - v[:, at]) - (v[:, at - 1] - v[:, at - 2])
    slope = np.abs(bend).max(axis=1)
    found = []
    for sign in (1.0, -1.0):
        w = sign * v
        x = w[:, at]
        top = (
            (x >= w[:, at - 1])
            & (x >= w[:, at - SPIKE_RADIUS])
            & (x > w[:, at + 1])
            & (x > w[:, at + SPIKE_RADIUS])
            & (x > w[:, [SPIKE_AT]])
        )
        place = np.argmax(np.where(top, x, -np.inf), axis=1)
        found.append((np.where(top.any(axis=1), x[rows, place] - w[:, SPIKE_AT], 0.0), at[place]))
    (rise, up), (fall, down) = found
    height = np.maximum(rise, fall)
    w = np.where(rise >= fall, 1.0, -1.0)[:, None] * v
    peak = np.where(rise >= fall, up, down)
    tries = peak[:, None] + np.arange(STOP_FIRST, STOP_LAST)[None, :]
    pick = lambda k: np.take_along_axis(w, tries + k, axis=1)
    turn = (pick(0) < pick(-1)) & (pick(0) <= pick(1)) & (pick(0) <= pick(3))
    late = np.where(slope >= SPIKE_SLOPE, peak + STOP_LAST, peak)
    stop = np.where(turn.any(axis=1), tries[rows, np.argmax(turn, axis=1)], late)
    real = (height > SPIKE_HEIGHT) & (w[rows, peak] - w[rows, stop] >= 0.5 * height)
    return real, peak, stop


def noise_spikes(windows: DataFrame, keys=BLOCK) -> DataFrame:
    """Spikes that follow the marks: start, peak and stop with their levels."""
    return _measured(windows).select(*keys, "_s.*").where(F.col("start_sn") > 0)


def _measured(windows: DataFrame) -> DataFrame:
    """Windows with the spike of each as ``_s``; one that holds none starts at 0."""
    schema = (
        "start_sn bigint, peak_sn bigint, stop_sn bigint, "
        "start_ppg double, peak_ppg double, stop_ppg double"
    )

    @F.pandas_udf(schema)
    def measure(sns: pd.Series, ppg: pd.Series) -> pd.DataFrame:
        v = np.array(ppg.tolist(), dtype=float).reshape(len(ppg), -1)
        sn = np.array(sns.tolist(), dtype=np.int64).reshape(len(sns), -1)
        rows = np.arange(len(v))
        real, peak, stop = _measure(v)
        start = np.full(len(v), SPIKE_AT)
        out = {}
        for name, at in (("start", start), ("peak", peak), ("stop", stop)):
            out[f"{name}_sn"] = np.where(real, sn[rows, at], 0)
            out[f"{name}_ppg"] = v[rows, at]
        return pd.DataFrame(out)[
            ["start_sn", "peak_sn", "stop_sn", "start_ppg", "peak_ppg", "stop_ppg"]
        ]

    # a filter on the result must not go below, where it would measure every window once more
    return windows.withColumn("_s", measure.asNondeterministic()("sns", "ppg"))


# Converter step in millivolts and screening thresholds.
MILLIVOLTS = 3300.0 / 65535.0
LOUD_MILLIVOLTS, FALSE_SPIKES_PER_MINUTE, MIN_DENSITY = 6.0, 3.0, 1.0


def noise_statistics(
    spikes: DataFrame, density: DataFrame, blocks: DataFrame, keys=BLOCK, per_minute: float = FALSE_SPIKES_PER_MINUTE
) -> DataFrame:
    """Box-plot statistics of spike amplitudes per block.

    Only spikes in windows denser than one per second count; a block with too
    few of them (``per_minute``) gives zeros.  ``spikes`` carry ``density``.
    """
    amp = F.abs(F.col("peak_ppg") - F.col("start_ppg")) * MILLIVOLTS
    dense = spikes.where(F.col("density") > MIN_DENSITY).withColumn("_amp", amp)
    mid = dense.groupBy(*keys).agg(
        F.median("_amp").alias("_mid"), F.count(F.lit(1)).alias("_n")
    )
    halves = (
        dense.join(mid, list(keys))
        .groupBy(*keys, "_mid", "_n")
        .agg(
            F.median(F.when(F.col("_amp") > F.col("_mid"), F.col("_amp"))).alias("_up"),
            F.median(F.when(F.col("_amp") < F.col("_mid"), F.col("_amp"))).alias("_down"),
            F.count(F.when(F.col("_amp") >= LOUD_MILLIVOLTS, 1)).alias("_loud"),
        )
    )
    bound = F.col("_up") + 1.5 * (F.col("_up") - F.col("_down"))
    whisker = (
        dense.join(halves, list(keys))
        .groupBy(*keys)
        .agg(F.max(F.when(F.col("_amp") <= bound, F.col("_amp"))).alias("_whisker"))
    )
    share = lambda x: F.lit(100.0) * F.count(F.when(F.col("density") >= x, 1)) / F.count(F.lit(1))
    windows = density.groupBy(*keys).agg(share(1).alias("_d1"), share(2).alias("_d2"), share(3).alias("_d3"))
    out = (
        blocks.join(halves, list(keys), "left")
        .join(whisker, list(keys), "left")
        .join(windows, list(keys), "left")
    )
    minutes = (F.col("sn_stop") - F.col("sn_start")) / (TICKS_PER_SECOND * 60.0)
    enough = minutes * per_minute < F.coalesce("_n", F.lit(0))
    cell = lambda c, name: F.when(enough, F.col(c).cast("double")).otherwise(F.lit(0.0)).alias(name)
    return out.select(
        *keys,
        cell("_mid", "median_mv"),
        cell("_up", "upper_mv"),
        cell("_down", "lower_mv"),
        cell("_whisker", "whisker_mv"),
        cell("_loud", "loud"),
        cell("_d1", "pct_over_1"),
        cell("_d2", "pct_over_2"),
        cell("_d3", "pct_over_3"),
    )


def vitals_under_noise(rows: DataFrame, keys=BLOCK) -> DataFrame:
    """Share displayed, median and maximum where density is at least one per second."""
    noisy = rows.where(F.col("density") >= MIN_DENSITY)
    good = F.when(F.col("value") > 0, F.col("value"))
    stats = noisy.groupBy(*keys).agg(
        (F.lit(100.0) * F.count(good) / F.count(F.lit(1))).alias("displayed_pct"),
        F.coalesce(F.median(good), F.lit(-1.0)).alias("median"),
        F.coalesce(F.max(good), F.lit(-1.0)).alias("maximum"),
    )
    every = rows.select(*keys).distinct()
    return every.join(stats, list(keys), "left").fillna(
        -1.0, ["displayed_pct", "median", "maximum"]
    )


MIN_MARKS = 240


def noise_report(
    ir_filtered: DataFrame,
    infrared: DataFrame,
    red: DataFrame,
    vitals: dict[str, DataFrame],
    keys=BLOCK,
    min_marks: int = MIN_MARKS,
) -> DataFrame:
    """One row per block: amplitudes and densities of radio noise on both
    lights, and the vital signs while it lasts (27 figures and the key)."""
    marks = radio_marks(ir_filtered, keys)
    blocks = infrared.groupBy(*keys).agg(F.min("sn").alias("sn_start"), F.max("sn").alias("sn_stop"))
    cells = _mark_cells([infrared, red], marks, keys).where(F.col("_marks") - 2 >= min_marks)
    # few rows, read several times below; the flat windows tell which blocks have enough marks
    measured = _measured(_cell_windows(cells, keys, carrier=True)).select(*keys, "_light", "mark_sn", "_s.*")
    measured = durable(measured.where(F.col("mark_sn").isNull() | (F.col("start_sn") > 0)))
    enough = measured.select(*keys).distinct()
    blocks = durable(blocks.join(enough, list(keys), "left_semi"))
    out, ir_density = blocks, None
    names = {
        "median_mv": "med", "upper_mv": "uqa", "lower_mv": "lqa", "whisker_mv": "limit",
        "loud": "quant", "pct_over_1": "nd1", "pct_over_2": "nd2", "pct_over_3": "nd3",
    }
    for k, label in enumerate(("ir", "red")):
        spikes = measured.where((F.col("_light") == k) & (F.col("start_sn") > 0)).drop("_light", "mark_sn")
        density = spike_density(spikes, blocks, keys=keys)
        ir_density = density if ir_density is None else ir_density
        spikes = with_density(spikes, density, blocks, keys=keys, at="start_sn")
        stats = noise_statistics(spikes, density, blocks, keys)
        out = out.join(
            stats.select(*keys, *[F.col(a).alias(f"{label}_{b}") for a, b in names.items()]), list(keys), "left"
        )
    for label, readings in vitals.items():
        dense = with_density(readings, ir_density, blocks, keys=keys)
        v = vitals_under_noise(dense, keys).select(
            *keys,
            F.col("displayed_pct").alias(f"{label}_disp"),
            F.col("median").alias(f"{label}_med"),
            F.col("maximum").alias(f"{label}_max"),
        )
        out = out.join(v, list(keys), "left").fillna(
            -1.0, [f"{label}_disp", f"{label}_med", f"{label}_max"]
        )
    return out


def beat_windows(
    beats: DataFrame,
    beats_per_window: int,
    seconds: float,
    every: float,
    keys=("session",),
) -> DataFrame:
    """The last n beats, no older than ``seconds``, at every update.

    Updates run every ``every`` seconds from the first beat.  A beat is in reach
    of the updates from its own time until the n-th beat after it or the end of
    the look-back, so these follow by arithmetic from one scan and no beat is
    paired with an update that does not keep it.
    """
    from .slices import balance, later, overall_max, overall_min, scan, unsliced

    known = beats.select(*keys, "t", "seq", "rr").dropna(subset=[*keys, "t"])
    checked = balance(known, keys, "t", grows=max(1.0, seconds / every))
    df = later(checked, keys, ["t", "seq"], "t", beats_per_window, "_next")
    df = unsliced(scan(df, keys, ["t", "seq"], _t0=overall_min("t"), _t1=overall_max("t")))
    n = F.ceil((F.col("_t1") - F.col("_t0")) / every).cast("bigint")
    number = lambda t: F.floor((t - F.col("_t0")) / every).cast("bigint")
    # one more on either side, as divisions are rounded; the comparisons below decide
    first = F.greatest(number(F.col("t")) - 1, F.lit(0))
    last = F.least(n - 1, number(F.col("t") + seconds) + 1, number(F.col("_next")) + 1)
    kept = (
        df.where(first <= last)
        .withColumn("update", F.explode(F.sequence(first, last)))
        .withColumn("stop", F.col("_t0") + F.col("update") * every)
        .where((F.col("t") >= F.col("stop") - seconds) & (F.col("t") <= F.col("stop")))
        .where(F.col("_next").isNull() | (F.col("_next") > F.col("stop")))
    )
    return kept.groupBy(*keys, "update", "stop").agg(
        F.sort_array(F.collect_list(F.struct("t", "seq", "rr"))).alias("_b")
    ).select(*keys, "update", "stop", F.col("_b.t").alias("ts"), F.col("_b.rr").alias("rr"))
