"""Time budgets: active, invalid, dropout and on-network time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import SENSOR_OFF
from .runs import ORDER, SERIES, is_invalid, marked


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(-1.0))


def _seconds(condition: Column | None, t: str) -> Column:
    span = F.coalesce(F.col("next_t") - F.col(t), F.lit(0.0))
    return F.sum(span if condition is None else F.when(condition, span).otherwise(F.lit(0.0)))


def _dropout(rate: Column, t: str) -> Column:
    lost = F.col("next_t") - F.col(t) - F.when(F.col("gap_head"), rate).otherwise(F.lit(0.0))
    return F.sum(F.when(F.col("gap"), lost).otherwise(F.lit(0.0)))


def parameter_times(readings: DataFrame, rate, slop=0.1, keys=SERIES, order=ORDER) -> DataFrame:
    """One row per series: seconds active, XX, dropout, on network, and shares.

    A run ends at the next sample, so the time of all runs is the sum of the
    steps that leave a flagged sample; a dropout starts one update after its
    sample, so each merged dropout loses one rate.
    """
    t = order[0]
    rate = rate if isinstance(rate, Column) else F.lit(float(rate))
    marks = marked(readings, rate, slop, keys=keys, order=order)
    sums = marks.groupBy(*keys).agg(
        _seconds(None, t).alias("active"),
        _seconds(F.col("flagged"), t).alias("xx"),
        _dropout(rate, t).alias("dropout"),
    )
    on = F.col("on_network")
    return (
        sums.withColumn("on_network", F.col("active") - F.col("dropout"))
        .withColumn("on_network_pct", percent(on, F.col("active")))
        .withColumn("display_pct", percent(on - F.col("xx"), on))
    )


def oximeter_times(readings: DataFrame, rate=3.0, slop=0.1, keys=SERIES, order=ORDER) -> DataFrame:
    """The SpO2 budget, with invalid time split into sensor off and on."""
    t = order[0]
    rate = rate if isinstance(rate, Column) else F.lit(float(rate))
    off = F.col("value") == SENSOR_OFF
    marks = marked(readings, rate, slop, is_invalid(F.col("value")) | off, keys, order)
    sums = marks.groupBy(*keys).agg(
        _seconds(None, t).alias("active"),
        _seconds(F.col("flagged"), t).alias("xx"),
        _seconds(off, t).alias("xx_sensor_off"),
        _dropout(rate, t).alias("dropout"),
    )
    on = F.col("on_network")
    return (
        sums.withColumn("xx_sensor_on", F.col("xx") - F.col("xx_sensor_off"))
        .withColumn("on_network", F.col("active") - F.col("dropout"))
        .withColumn("on_network_pct", percent(on, F.col("active")))
        .withColumn("display_pct", percent(on - F.col("xx"), on))
        .withColumn("display_sensor_on_pct", percent(on - F.col("xx_sensor_on"), on))
        .withColumn("sensor_off_pct", percent(F.col("xx_sensor_off"), on))
    )


def session_times(
    times: DataFrame,
    wrist=("TIME_SYNC", "PR", "SPO2"),
    cable=("TEMP", "HR", "RR"),
    key="session",
) -> DataFrame:
    """Wrist, cable and whole-session time from the per-parameter rows."""

    def best(names, column):
        return F.coalesce(F.max(F.when(F.col("param").isin(*names), F.col(column))), F.lit(-1.0))

    return (
        times.groupBy(key)
        .agg(
            best(wrist, "on_network").alias("wrist_on_network"),
            best(wrist, "active").alias("wrist_active"),
            best(cable, "on_network").alias("cable_on_network"),
            best(cable, "active").alias("cable_active"),
        )
        .withColumn("session_on_network", F.greatest("wrist_on_network", "cable_on_network"))
        .withColumn("session_active", F.greatest("wrist_active", "cable_active"))
    )


def spot_times(readings: DataFrame, keys=SERIES) -> DataFrame:
    """Spot readings (cuff) counted instead of timed."""
    on = F.col("on_network")
    return (
        readings.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).cast("double").alias("active"),
            F.sum(F.when(is_invalid(F.col("value")), 1.0).otherwise(0.0)).alias("xx"),
        )
        .withColumn("dropout", F.lit(0.0))
        .withColumn("on_network", F.col("active"))
        .withColumn("on_network_pct", F.lit(-1.0))
        .withColumn("display_pct", percent(on - F.col("xx"), on))
    )


def session_summary(times: DataFrame, totals: DataFrame, params: list[str], key="session") -> DataFrame:
    """One row per session: whole seconds and shares to two places, per parameter."""

    def cell(name, column):
        return F.max(F.when(F.col("param") == name, F.col(column)))

    per_param = times.groupBy(key).agg(
        *[
            c
            for p in params
            for c in (
                F.rint(cell(p, "active")).cast("bigint").alias(f"time_{p.lower()}"),
                F.rint(cell(p, "xx")).cast("bigint").alias(f"time_in_xx_{p.lower()}"),
                F.round(cell(p, "display_pct"), 2).alias(f"display_percent_{p.lower()}"),
            )
        ]
    )
    whole = totals.select(
        key,
        F.rint("wrist_active").cast("bigint").alias("duration"),
        F.rint("wrist_active").cast("bigint").alias("time_wt"),
        F.rint("cable_active").cast("bigint").alias("time_cable"),
        F.rint("session_active").cast("bigint").alias("time_total"),
        F.rint("session_on_network").cast("bigint").alias("time_on_network"),
    )
    return whole.join(per_param, key)


def sensor_off_codes(spo2: DataFrame, alarms: DataFrame, off_code: int = 33) -> DataFrame:
    """Mark invalid SpO2 readings inside a sensor-off stretch with -10.

    A stretch starts at an "off" alarm (consecutive alarms of one start
    counted once) and lasts to the next reading at which SpO2 comes back.
    Keys: session; ``spo2`` has t, seq, value and may have sn; ``alarms`` t, seq, code, start_sn.
    """
    from .runs import changes
    from .slices import balance, filled, filled_before, overall_max, scan, unsliced

    fresh = changes(alarms, ["session"], ["t", "seq"], F.col("start_sn"))
    off = fresh.where(F.col("code") == off_code).select(
        "session", "t", F.lit(0).alias("kind"), "seq", F.lit(None).cast("double").alias("value")
    )
    kept = [c for c in ("sn",) if c in spo2.columns]
    rows = spo2.select("session", "t", F.lit(1).alias("kind"), "seq", "value", *kept)
    both = balance(off.unionByName(rows, allowMissingColumns=True), ["session"], "t")
    order = ["t", "kind", "seq"]
    ok = F.when(F.col("kind") == 1, F.col("value") > 0)
    both = scan(both, ["session"], order, _ok=filled_before(ok))
    back = (F.col("kind") == 1) & (F.col("value") > 0) & ~F.coalesce("_ok", F.lit(False))
    event = F.when(F.col("kind") == 0, 0).when(back, 1)
    both = scan(
        both.withColumn("_event", event),
        ["session"],
        order,
        _state=filled("_event"),
        _any_on=overall_max(F.when(F.col("_event") == 1, 1)),
        _last_t=overall_max(F.when(F.col("kind") == 1, F.col("t"))),
    )
    inside = (
        (F.coalesce("_state", F.lit(1)) == 0)
        & (F.col("_any_on") == 1)
        & (F.col("t") < F.col("_last_t"))
        & is_invalid(F.col("value"))
    )
    return unsliced(
        both.where("kind = 1")
        .withColumn("value", F.when(inside, F.lit(float(SENSOR_OFF))).otherwise(F.col("value")))
        .select("session", "t", "seq", "value", *kept, *([c for c in both.columns if c == "_slice"]))
    )
