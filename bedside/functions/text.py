"""Log messages and file names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: placeholder of a message template.
PLACEHOLDER = r"\(\[([-AZFazf09.s_\\]*)\]\*\)"


def rebuilt_message(template: Column, content: Column) -> Column:
    """Template placeholders filled in order, then ``$ \\ ^`` stripped.

    Placeholders without content stay; content without placeholder is ignored.
    Content is data, never a pattern.
    """
    parts = F.split(template, PLACEHOLDER)
    holders = F.regexp_extract_all(template, F.lit(f"({PLACEHOLDER})"), F.lit(1))
    filled = F.transform(holders, lambda h, i: F.coalesce(F.get(content, i), h))
    text = F.concat_ws(
        "",
        F.transform(
            parts,
            lambda p, i: F.concat(p, F.coalesce(F.get(filled, i), F.lit(""))),
        ),
    )
    return F.regexp_replace(text, r"[$\\^]", "")


def analytics_text(df: DataFrame, formats: dict[int, str], subtype: str, fields: list[str]) -> DataFrame:
    """Analytics records to log text by the format string of their subtype."""
    text = F.lit(None).cast("string")
    for kind, pattern in formats.items():
        text = F.when(F.col(subtype) == kind, F.format_string(pattern, *fields)).otherwise(text)
    return df.withColumn("message", text)


def session_file(path: Column) -> Column:
    """Array name of a stored file: fourth part of its path without extension."""
    return F.element_at(F.split(F.get(F.split(path, "/"), 3), r"\."), 1)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)
