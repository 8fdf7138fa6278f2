"""Ordered scans over series that stay balanced under skew.

A scan (previous row, running sum, forward fill ...) is a window over one
series.  Windows put a whole series into one task, so a series that holds a
large share of all rows is cut into slices of its order axis first
(:func:`balance`).  :func:`scan` then works slice by slice and adds what the
earlier (or later) slices of the series contribute from one summary row per
slice.  The tables of slices and summaries are joined by key; nothing of them
reaches the driver, and Spark broadcasts them only if they are small.  Series
below the limit, the usual case, run as plain windows with no extra work.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

SLICE = "_slice"
SLICE_ROWS = "spark.bedside.sliceRows"
TASK_ROWS = "spark.bedside.taskRows"
BINS_PER_SLICE = 8


_EVEN: dict = {}  # rows of plans without a big series


def balance(
    df: DataFrame, keys: Sequence[str], t: str, reduced: DataFrame | None = None, grows: float = 1.0
) -> DataFrame:
    """Add a slice column to ``df`` when some series exceeds the row limit.

    One narrow aggregation finds the series above the limit, whatever their
    number; slices hold about as many rows as the limit says.  That a plan has
    no such series is remembered; should its data have grown since, that costs
    balance, not correctness.

    ``reduced`` names a frame checked before that holds at least as many rows
    per key; when that needed no slices, neither does ``df``.

    Sorted rows of a scan fill the memory of their task, and Spark merges small
    partitions by what they hold before the scan.  So series without slices are
    dealt to as many partitions as their rows ask for, 250,000 rows each;
    ``grows`` says how many rows come of one after the first scan.
    """
    if SLICE in df.columns or (reduced is not None and SLICE not in reduced.columns):
        return df
    limit = float(df.sparkSession.conf.get(SLICE_ROWS, "4000000"))
    plan = (df.semanticHash(), *keys, t, limit)
    if plan in _EVEN:
        return _dealt(df, keys, _EVEN[plan] * grows)
    sizes = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(t).cast("double").alias("_t0"),
        F.max(t).cast("double").alias("_t1"),
    )
    rows, longest = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_n"), F.lit(0))).first()
    if longest <= limit:
        if len(_EVEN) > 1000:
            _EVEN.clear()
        _EVEN[plan] = rows
        return _dealt(df, keys, rows * grows)
    return _cut(df, keys, t, durable(_big_series(sizes, keys, limit)), limit)


def _dealt(df: DataFrame, keys: Sequence[str], rows: float) -> DataFrame:
    """Series dealt to partitions by their rows, once these are more than there are cores."""
    parts = math.ceil(rows / float(df.sparkSession.conf.get(TASK_ROWS, "250000")))
    if parts <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(parts, *keys)


def _big_series(sizes: DataFrame, keys: Sequence[str], limit: float) -> DataFrame:
    """Key, start, bin width and number of bins of every series above the limit."""
    bins = F.lit(BINS_PER_SLICE) * F.ceil(F.col("_n") / F.lit(limit))
    width = (F.coalesce("_t1", F.lit(0.0)) - F.coalesce("_t0", F.lit(0.0))) / bins
    return sizes.where(F.col("_n") > limit).select(
        *[F.col(k).alias(f"_b_{k}") for k in keys],
        "_t0",
        F.when(width > 0, width).otherwise(F.lit(1.0)).alias("_width"),
        bins.cast("bigint").alias("_bins"),
    )


def _cut(df: DataFrame, keys: Sequence[str], t: str, table: DataFrame, limit: float) -> DataFrame:
    """Slices of about ``limit`` rows, from the row counts of fine bins.

    Bins are equal in ``t``; one that holds a burst is divided again.  Bins of
    a sparse stretch end up in one slice.  Every bin has a slice, so rows that
    come later still fall in order.  Rows without ``t`` sort first.
    """
    own = [f"_b_{k}" for k in keys]

    def same(columns, prefix):
        return _all(F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in columns)

    def clipped(index: Column, top: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.coalesce(index, F.lit(0)), top))

    def counted(rows_: DataFrame, columns) -> DataFrame:
        return rows_.groupBy(*[F.col(k).alias(f"_n_{k}") for k in columns]).agg(
            F.count(F.lit(1)).alias("_n")
        )

    at = (F.col(t).cast("double") - F.col("_t0")) / F.col("_width")
    placed = df.join(table, same(keys, "_b_"), "left").withColumn(
        "_bin", F.when(F.col("_width").isNotNull(), clipped(F.floor(at), F.col("_bins")))
    )
    big = placed.where(F.col("_bin").isNotNull())
    heavy = (
        counted(big, [*keys, "_bin"])
        .where(F.col("_n") > 2 * limit)
        .withColumn("_parts", (F.ceil(F.col("_n") / F.lit(limit)) * BINS_PER_SLICE).cast("bigint"))
        .drop("_n")
    )
    heavy = durable(heavy)
    within = F.floor((at - F.col("_bin")) * F.col("_parts"))
    placed = (
        placed.join(heavy, same([*keys, "_bin"], "_n_"), "left")
        .withColumn("_sub", F.when(F.col("_parts").isNotNull(), clipped(within, F.col("_parts") - 1)).otherwise(F.lit(0)))
        .select(*df.columns, "_bin", "_sub")
    )
    counts = counted(placed.where(F.col("_bin").isNotNull()), [*keys, "_bin", "_sub"])
    bins = table.select(*own, F.explode(F.sequence(F.lit(0).cast("bigint"), "_bins")).alias("_b__bin"))
    paired = _all(
        F.col(f"_b_{k}").eqNullSafe(F.col(f"_n_{k}")) for k in [*keys, "_bin"]
    )
    dense = bins.join(heavy, paired, "left").select(
        *own,
        "_b__bin",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)) - 1)).alias("_b__sub"),
    )
    places = [*keys, "_bin", "_sub"]
    paired = _all(F.col(f"_b_{k}").eqNullSafe(F.col(f"_n_{k}")) for k in places)
    before = (
        Window.partitionBy(*own)
        .orderBy("_b__bin", "_b__sub")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = F.coalesce(F.sum(F.coalesce("_n", F.lit(0))).over(before), F.lit(0))
    cuts = dense.join(counts, paired, "left").select(
        *own, "_b__bin", "_b__sub", F.floor(earlier / F.lit(limit)).alias(SLICE)
    )
    return placed.join(durable(cuts), same(places, "_b_"), "left").select(
        *df.columns, SLICE
    )


def kept_slice(df: DataFrame) -> list[Column]:
    """Aggregate that keeps the slice of rows grouped along the order axis."""
    return [F.min(SLICE).alias(SLICE)] if SLICE in df.columns else []


def unsliced(df: DataFrame) -> DataFrame:
    return df.drop(SLICE)


@dataclass(frozen=True)
class Spec:
    kind: str
    column: Column


def _spec(kind: str):
    def make(column: Column | str) -> Spec:
        return Spec(kind, F.col(column) if isinstance(column, str) else column)

    return make


previous = _spec("previous")  # value of the row before
following = _spec("following")  # value of the row after
running_sum = _spec("running_sum")  # up to and including this row
running_max = _spec("running_max")
running_min = _spec("running_min")
filled = _spec("filled")  # last non-null up to and including this row
filled_before = _spec("filled_before")  # last non-null before this row
refilled = _spec("refilled")  # first non-null from this row on
refilled_after = _spec("refilled_after")  # first non-null after this row
overall_max = _spec("overall_max")  # maximum of the whole series
overall_min = _spec("overall_min")


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], **specs: Spec) -> DataFrame:
    """Append one column per spec, computed along ``order`` within ``keys``.

    ``order`` must be total within a series and start with the axis that
    :func:`balance` sliced on.
    """
    sliced = SLICE in df.columns
    part = [*keys, SLICE] if sliced else [*keys]
    ahead = Window.partitionBy(*part).orderBy(*order)
    behind = Window.partitionBy(*part).orderBy(*[F.col(c).desc() for c in order])
    work = df.select("*", *[s.column.alias(f"_x_{name}") for name, s in specs.items()])
    local = {
        name: _local(s.kind, F.col(f"_x_{name}"), ahead, behind, Window.partitionBy(*part), sliced)
        for name, s in specs.items()
    }
    if not sliced:
        out = work.select(*df.columns, *[c.alias(n) for n, c in local.items()])
        return out
    inside = work.select(*df.columns, *[c.alias(f"_in_{n}") for n, c in local.items()])
    carry = _carry(work, keys, order, specs)
    same = _all(F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in [*keys, SLICE])
    joined = inside.join(carry, same, "left")
    return durable(
        joined.select(
            *df.columns,
            *[
                _combine(s.kind, F.col(f"_in_{n}"), F.col(f"_carry_{n}")).alias(n)
                for n, s in specs.items()
            ],
        )
    )


def later(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, n: int, name: str) -> DataFrame:
    """Append ``column`` of the row ``n`` rows on in the series; keys must not be null."""
    if SLICE not in df.columns:
        return df.withColumn(name, F.lead(column, n).over(Window.partitionBy(*keys).orderBy(*order)))
    numbered = scan(df, keys, order, _place=running_sum(F.lit(1)))
    ahead = numbered.select(*keys, (F.col("_place") - n).alias("_place"), F.col(column).alias(name))
    return numbered.join(ahead, [*keys, "_place"], "left").select(*df.columns, name)


def _local(kind, x, ahead, behind, whole, sliced) -> Column:
    upto = ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    back_upto = behind.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back_before = behind.rowsBetween(Window.unboundedPreceding, -1)
    cell = F.struct(x.alias("v")) if sliced else x
    return {
        "previous": lambda: F.lag(cell).over(ahead),
        "following": lambda: F.lead(cell).over(ahead),
        "running_sum": lambda: F.sum(x).over(upto),
        "running_max": lambda: F.max(x).over(upto),
        "running_min": lambda: F.min(x).over(upto),
        "filled": lambda: F.last(x, ignorenulls=True).over(upto),
        "filled_before": lambda: F.last(x, ignorenulls=True).over(before),
        "refilled": lambda: F.last(x, ignorenulls=True).over(back_upto),
        "refilled_after": lambda: F.last(x, ignorenulls=True).over(back_before),
        "overall_max": lambda: F.max(x).over(whole),
        "overall_min": lambda: F.min(x).over(whole),
    }[kind]()


def _carry(work: DataFrame, keys, order, specs) -> DataFrame:
    """One row per slice: what the other slices of the series contribute."""
    place = F.struct(*order)
    sums = []
    for name, s in specs.items():
        x = F.col(f"_x_{name}")
        present = F.when(x.isNotNull(), place)
        agg = {
            "previous": lambda x=x: F.max_by(F.struct(x.alias("v")), place),
            "following": lambda x=x: F.min_by(F.struct(x.alias("v")), place),
            "running_sum": lambda x=x: F.sum(x),
            "running_max": lambda x=x: F.max(x),
            "running_min": lambda x=x: F.min(x),
            "filled": lambda x=x, p=present: F.max_by(x, p),
            "filled_before": lambda x=x, p=present: F.max_by(x, p),
            "refilled": lambda x=x, p=present: F.min_by(x, p),
            "refilled_after": lambda x=x, p=present: F.min_by(x, p),
            "overall_max": lambda x=x: F.max(x),
            "overall_min": lambda x=x: F.min(x),
        }[s.kind]()
        sums.append(agg.alias(f"_s_{name}"))
    summary = work.where(F.col(SLICE).isNotNull()).groupBy(*keys, SLICE).agg(*sums)
    before = (
        Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    after = (
        Window.partitionBy(*keys)
        .orderBy(F.col(SLICE).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*keys)
    cols = []
    for name, s in specs.items():
        x = F.col(f"_s_{name}")
        value = {
            "previous": lambda x=x: F.last(x, ignorenulls=True).over(before),
            "following": lambda x=x: F.last(x, ignorenulls=True).over(after),
            "running_sum": lambda x=x: F.sum(x).over(before),
            "running_max": lambda x=x: F.max(x).over(before),
            "running_min": lambda x=x: F.min(x).over(before),
            "filled": lambda x=x: F.last(x, ignorenulls=True).over(before),
            "filled_before": lambda x=x: F.last(x, ignorenulls=True).over(before),
            "refilled": lambda x=x: F.last(x, ignorenulls=True).over(after),
            "refilled_after": lambda x=x: F.last(x, ignorenulls=True).over(after),
            "overall_max": lambda x=x: F.max(x).over(whole),
            "overall_min": lambda x=x: F.min(x).over(whole),
        }[s.kind]()
        cols.append(value.alias(f"_carry_{name}"))
    return summary.select(*[F.col(k).alias(f"_c_{k}") for k in [*keys, SLICE]], *cols)


def _combine(kind: str, inside: Column, carry: Column) -> Column:
    if kind in ("previous", "following"):
        return F.coalesce(inside, carry)["v"]
    if kind == "running_sum":
        return F.when(
            inside.isNotNull() | carry.isNotNull(),
            F.coalesce(inside, inside * 0, carry * 0) + F.coalesce(carry, inside * 0),
        )
    if kind in ("running_max", "overall_max"):
        return F.greatest(inside, carry)
    if kind in ("running_min", "overall_min"):
        return F.least(inside, carry)
    return F.coalesce(inside, carry)


def _all(conditions) -> Column:
    out = None
    for c in conditions:
        out = c if out is None else out & c
    return out
