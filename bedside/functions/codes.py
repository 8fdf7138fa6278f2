"""Reading states, vendor codes and units as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import SCALES


def recode(value: Column) -> Column:
    """Vendor codes 16374..16383 to the states -10..-1."""
    return F.when(value.between(16374, 16383) & (value == F.floor(value)), value - 16384).otherwise(value)


def state(value: Column) -> Column:
    """Text of a reading: XX, ++ or --, null when it is a value."""
    return (
        F.when((value < 0) & (value > -4), "XX")
        .when(value == -4, "++")
        .when(value == -5, "--")
        .when(value < 0, "OFF")
    )


def valid(value: Column) -> Column:
    return F.when(value > -1, value)


def without_low_bits(value: Column) -> Column:
    """Drop the low eight bits of an ECG sample (arithmetic shift)."""
    return F.shiftright(value, 8)


def to_units(df: DataFrame, value: str = "value", kind: str = "kind") -> DataFrame:
    """Engineering units by the kind of series; other kinds stay as they are."""
    factor = F.lit(1.0)
    for name, scale in SCALES.items():
        factor = F.when(F.col(kind) == name, F.lit(scale)).otherwise(factor)
    return df.withColumn(value, F.col(value) * factor)


def zeroed(df: DataFrame, keys, t: str = "t") -> DataFrame:
    """Time since the first row of each key."""
    first = df.groupBy(*keys).agg(F.min(t).alias("_t0"))
    return df.join(first, list(keys)).withColumn(t, F.col(t) - F.col("_t0")).drop("_t0")


def saturated(value: Column, high: int) -> Column:
    """NaN samples become the high-saturation code."""
    return F.nanvl(value.cast("double"), F.lit(float(high)))


def decoded(df: DataFrame, codes: DataFrame, code: str = "code", text: str = "text") -> DataFrame:
    """Text of a code from a small (code, text) dimension; unknown codes give null."""
    named = codes.select(F.col("code").alias(code), F.col("text").alias(text))
    return df.join(named, code, "left")


def joined_text(df: DataFrame, codes: DataFrame, keys, placeholder: int = 999) -> DataFrame:
    """Distinct code texts of each group, sorted and joined with blanks.

    Codes from ``placeholder`` up carry no alarm and are left out.
    """
    distinct = df.where(F.col("code") < placeholder).select(*keys, "code").distinct()
    return (
        distinct.join(codes, "code")
        .groupBy(*keys)
        .agg(F.array_join(F.array_sort(F.collect_set("text")), " ").alias("text"))
    )


def by_precedence(df: DataFrame, sources: list[str], keys, source: str = "source") -> DataFrame:
    """Per key only the rows of the first source that has any."""
    rank = F.lit(len(sources))
    for i, name in reversed(list(enumerate(sources))):
        rank = F.when(F.col(source) == name, F.lit(i)).otherwise(rank)
    ranked = df.where(F.col(source).isin(*sources)).withColumn("_rank", rank)
    best = ranked.groupBy(*keys).agg(F.min("_rank").alias("_best"))
    return ranked.join(best, list(keys)).where("_rank = _best").drop("_rank", "_best")


def components(df: DataFrame, prefix: str, keys=("session", "sn", "t")) -> DataFrame:
    """Cuff columns sys, dia, map to one series each."""
    wide = df.select(
        *keys, *[F.col(c).alias(f"{prefix}_{c.upper()}") for c in ("sys", "dia", "map")]
    )
    return wide.unpivot(
        list(keys), [f"{prefix}_{c}" for c in ("SYS", "DIA", "MAP")], "param", "value"
    )


def in_sequence(sn: Column, low: Column, high: Column, always: Column, first_block: Column) -> Column:
    """Packets of a block: logs and analytics always, block 0 from zero on."""
    return always | ((sn >= F.when(first_block, F.lit(0)).otherwise(low)) & (sn <= high) & (sn > 0))
