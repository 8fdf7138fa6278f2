"""Session mining: every result table of the stored sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import components
from ..model import UPDATE_RATES, UPDATE_RATES_COMBINED, VALUE_RANGES
from ..operators import alarms as al
from ..operators import asof, budget, cardiac, hist, ranges, runs
from ..operators.slices import balance
from ..session import durable, literal_table

SPOT = ("BP_SYS", "BP_DIA", "BP_MAP")


def rate_column(combined: bool = False):
    rates = UPDATE_RATES_COMBINED if combined else UPDATE_RATES
    out = F.lit(5.0)
    for name, seconds in rates.items():
        out = F.when(F.col("param") == name, F.lit(seconds)).otherwise(out)
    return out


def series(readings: DataFrame, bp: DataFrame, cnibp: DataFrame) -> DataFrame:
    """All scalar series of a session: readings, cuff components and HR_A."""
    cuff = components(bp, "BP", ("session", "sn", "t", "seq"))
    continuous = components(cnibp, "CNIBP", ("session", "sn", "t", "seq"))
    base = readings.select("session", "param", "sn", "t", "seq", "value")
    hr = base.where("param = 'HR'")
    pr = base.where("param = 'PR'").select("session", "t", "seq", "value")
    needed = asof.heart_rate_when_needed(hr, pr).withColumn("param", F.lit("HR_A"))
    out = base.unionByName(needed.select(*base.columns))
    for part in (cuff, continuous):
        out = out.unionByName(part.select(*base.columns))
    return out


def mine(
    spark: SparkSession,
    readings: DataFrame,
    bp: DataFrame,
    cnibp: DataFrame,
    device_alarms: DataFrame,
    limits: DataFrame | None = None,
    combined: bool = False,
) -> dict[str, DataFrame]:
    """Result tables by name, one plan each over all sessions together.

    What several tables read (the series, their marks, the alarms) is written
    once and read back, so a lost executor costs a table, not the whole job.
    """
    everything = durable(series(readings, bp, cnibp))
    timed = everything.where(~F.col("param").isin(*SPOT))
    rate = rate_column(combined)
    slop = 0.1
    marks = durable(runs.numbered(runs.marked(timed, rate, slop)))
    gaps = runs.dropouts(marks, rate)
    invalid = runs.state_runs(marks, rate)
    times = budget.parameter_times(timed, rate, slop).unionByName(
        budget.spot_times(everything.where(F.col("param").isin(*SPOT)))
        .select("session", "param", "active", "xx", "dropout", "on_network", "on_network_pct", "display_pct")
    )
    limits = limits if limits is not None else al.limit_table(spark)
    alarms = durable(al.threshold_alarms(everything, limits))
    span = F.col("stop") - F.col("start")
    value_ranges = literal_table(
        spark, [(p, lo, hi) for p, (lo, hi) in VALUE_RANGES.items()], "param string, low int, high int"
    )
    totals = budget.session_times(times)
    invalid_cardiac, dropouts_cardiac, sweep_cardiac = cardiac_tables(everything, invalid, gaps, alarms)
    notices = device_alarms.distinct()
    ordered = notices if "seq" in notices.columns else notices.withColumn("seq", F.col("start_sn"))
    oximeter = everything.where("param = 'SPO2'")
    off = budget.sensor_off_codes(oximeter, ordered).withColumn("param", F.lit("SPO2"))
    return {
        "cardiac_invalid": invalid_cardiac,
        "cardiac_dropouts": dropouts_cardiac,
        "cardiac_invalid_histogram": hist.duration_histogram(invalid_cardiac, ["session"], span),
        "cardiac_dropout_histogram": hist.duration_histogram(dropouts_cardiac, ["session"], span),
        "cardiac_sweep": sweep_cardiac,
        "oximeter_times": budget.oximeter_times(off, slop=slop),
        "alarm_changes": runs.changes(ordered, ["session", "start_sn"], ["t", "seq"], F.struct("code", "state")),
        "alarm_code_histogram": hist.code_histogram(notices, ["session"], F.col("code")),
        "times": times,
        "session_times": totals,
        "summary": budget.session_summary(times, totals, sorted(UPDATE_RATES)),
        "dropouts": gaps.drop("inside_run"),
        "invalid_runs": invalid.drop("run_id"),
        "invalid_histogram": hist.duration_histogram(
            invalid, ["session", "param"], span, dropout_seconds=F.col("dropout")
        ),
        "dropout_histogram": hist.duration_histogram(gaps, ["session", "param"], span),
        "alarm_sweep": al.delay_sweep(alarms),
        "alarm_histogram": hist.duration_histogram(
            alarms, ["session", "param", "kind", "limit"], span - F.col("xx")
        ),
        "value_histogram": hist.value_histogram(everything, value_ranges),
        "device_alarm_histogram": hist.alarm_histogram(notices),
        "cuff_values": asof.cuff_pairs(bp, cnibp),
        "agreement": asof.agreement_pairs(bp, cnibp),
    }


def cardiac_tables(everything: DataFrame, invalid: DataFrame, gaps: DataFrame, alarms: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Where the cardiac rate (PR, or HR while PR is XX) is XX or dropped, and its alarms at all limits and delays."""
    pair = F.col("param").isin("PR", "HR")
    low = F.lower("param")
    layers = invalid.where(pair).select("session", F.concat(low, F.lit("_xx")).alias("layer"), "start", "stop").unionByName(
        gaps.where(pair).select("session", F.concat(low, F.lit("_drop")).alias("layer"), "start", "stop")
    )
    presence = everything.groupBy("session").agg(
        F.bool_or(F.col("param") == "PR").alias("has_pr"), F.bool_or(F.col("param") == "HR").alias("has_hr")
    )
    cut = al.cardiac_cut(layers, presence, balance(everything.where(pair), ["session"], "t"))
    sweep = cardiac.cardiac_sweep(alarms, invalid.where("param = 'PR'"))
    return al.cardiac_invalid(cut), al.cardiac_dropout(cut), sweep


def calibration_table(calibrations, cuff, connections, time_sync, posture, arm) -> DataFrame:
    """Calibration times with device swaps read off the time sync."""
    swaps = runs.epochs(time_sync, ["session"])
    first = swaps.groupBy("session", "epoch").agg(F.min("t").alias("t")).where("epoch > 0")
    return ranges.calibration_times(
        calibrations, cuff, connections, first.select("session", "t"), posture, arm
    )


def write(results: dict[str, DataFrame], root: str, sessions: DataFrame) -> None:
    """Store every table so that a re-run replaces exactly these sessions."""
    from ..sources.sinks import replace_sessions

    for name, df in results.items():
        replace_sessions(df, f"{root}/{name}", sessions)
