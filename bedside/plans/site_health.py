"""Site health: monitored hours, alarms per day and the indicator table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import TIME_CLASS
from ..sources.sinks import upserted

MIN_DURATION = 3600


def eligible(sessions: DataFrame, first_day: str, last_day: str, min_duration=MIN_DURATION) -> DataFrame:
    return sessions.where(
        F.col("date_stop").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))
        & (F.col("duration") >= min_duration)
    )


def site_hours(sessions: DataFrame, first_day: str, last_day: str, min_duration=MIN_DURATION) -> DataFrame:
    """Sessions and hours per site, care unit (null is a unit) and stop date."""
    return (
        eligible(sessions, first_day, last_day, min_duration)
        .groupBy("site", "care_unit", "date_stop")
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            (F.sum("duration").cast("double") / 3600.0).alias("hours"),
        )
    )


def one_unit(df: DataFrame, care_unit: str | None) -> DataFrame:
    """Rows of one care unit; None is the sessions without one."""
    return df.where(F.col("care_unit").eqNullSafe(F.lit(care_unit).cast("string")))


def monitored_seconds(param: Column) -> Column:
    """The session time that divides the alarms of a parameter."""
    out = F.lit(None).cast("double")
    for name, column in TIME_CLASS.items():
        out = F.when(param == name, F.col(column).cast("double")).otherwise(out)
    return out


def alarms_per_day(
    alarms: DataFrame,
    sessions: DataFrame,
    defaults: DataFrame,
    first_day: str,
    last_day: str,
    min_duration=MIN_DURATION,
) -> DataFrame:
    """Alarms per monitored day at the site's default limit and delay.

    ``alarms``: session, param, kind, limit, delay, alarms.  ``defaults``: site,
    param, kind, limit, delay.  HR_A uses the defaults of HR.  Only the sweep
    rows at a default survive the first join, before sessions are shuffled.
    """
    hr_a = defaults.where("param = 'HR'").withColumn("param", F.lit("HR_A"))
    wanted = defaults.unionByName(hr_a).withColumnRenamed("site", "_site")
    on = ["param", "kind", "limit", "delay"]
    at_default = alarms.join(wanted.select(*on).distinct(), on, "left_semi")
    facts = at_default.join(eligible(sessions, first_day, last_day, min_duration), "session")
    same = reduce(lambda a, b: a & b, [F.col(f"f.{c}") == F.col(f"d.{c}") for c in on])
    facts = facts.alias("f").join(
        wanted.alias("d"), same & (F.col("f.site") == F.col("d._site")), "left_semi"
    )
    days = monitored_seconds(F.col("param")) / 86400.0
    return facts.groupBy("site", "care_unit", "date_stop", "param", "kind").agg(
        F.sum(F.try_divide(F.col("alarms").cast("double"), days)).alias("apd")
    )


GROUPS = {"SPO2": "spo2", "CR": "cr", "RR": "rr", "PR": "pr", "HR": "hr", "HR_A": "hr_a",
          "CNIBP_SYS": "cnibp", "CNIBP_DIA": "cnibp", "CNIBP_MAP": "cnibp"}
NOT_IN_TOTAL = ("cr", "hr")


def indicators(apd: DataFrame, hours: DataFrame) -> DataFrame:
    """One row per site, unit and date: alarms per day and session by parameter.

    HIGH and LOW add up; the total leaves out CR and HR, which other columns
    already hold.  All units come from one pass.
    """
    group = F.lit(None).cast("string")
    for param, name in GROUPS.items():
        group = F.when(F.col("param") == param, F.lit(name)).otherwise(group)
    names = sorted(set(GROUPS.values()))
    keys = ["site", "care_unit", "date_stop"]
    sums = (
        apd.withColumn("_g", group)
        .groupBy(*keys)
        .agg(
            *[F.sum(F.when(F.col("_g") == n, F.col("apd"))).alias(f"_{n}") for n in names],
            F.sum(F.when(~F.col("_g").isin(*NOT_IN_TOTAL), F.col("apd"))).alias("_total"),
        )
    )
    same = (
        (F.col("h.site") == F.col("s.site"))
        & F.col("h.care_unit").eqNullSafe(F.col("s.care_unit"))
        & (F.col("h.date_stop") == F.col("s.date_stop"))
    )
    joined = hours.alias("h").join(sums.alias("s"), same, "left")
    return joined.select(
        *[F.col(f"h.{k}").alias(k) for k in keys],
        "h.sessions",
        "h.hours",
        *[
            F.coalesce(F.col(f"s._{n}") / F.col("h.sessions"), F.lit(0.0)).alias(f"apd_{n}")
            for n in ["total", *names]
        ],
    )


def updated_indicators(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Indicator table with the fresh rows written over or added."""
    return upserted(existing, fresh, ["site", "care_unit", "date_stop"])
