"""The library in SQL, and functions of a user beside it.

:func:`register` makes the following known to ``spark.sql`` for the session:

* ``recoded(value)``, ``reading_state(value)``, ``serial_number(id)``: as in ``codes`` and ``device``
* ``sample_rows(sn, samples, sample_rate, channels)``: a packet's samples, one row per tick and channel
* ``alarm_rows(alarms)``: a packet's active alarms, or its placeholder row
* ``block_rows(TABLE(segments))``: about two-hour blocks of segments, numbered on per session

The first ones are SQL, so they are planned into the query that calls them.  Blocks are
numbered in order, which takes a Python table function: Spark sends it the segments of a
session in order, a long one in strips, and all it holds is a number and a strip's blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, SelectedColumn

from ..model import TICKS_PER_SECOND
from .device import FIRST_YEAR

PLACEHOLDER_CODE = 999
ALARM = "STRUCT<code: BIGINT, severity: INT, state: INT, start_sn: BIGINT>"

SCALARS = {
    "recoded": (
        "value DOUBLE",
        "DOUBLE",
        "CASE WHEN value BETWEEN 16374 AND 16383 AND value = floor(value) THEN value - 16384 ELSE value END",
    ),
    "reading_state": (
        "value DOUBLE",
        "STRING",
        "CASE WHEN value < 0 AND value > -4 THEN 'XX' WHEN value = -4 THEN '++' WHEN value = -5 THEN '--' WHEN value < 0 THEN 'OFF' END",
    ),
    "serial_number": (
        "id BIGINT",
        "STRING",
        f"""concat('????20', lpad(string((shiftright(id, 18) & 63) + {FIRST_YEAR}), 2, '0'),
        lpad(string(shiftright(id, 14) & 15), 2, '0'), lpad(string(id & 16383), 5, '0'))""",
    ),
}

TABLES = {
    "sample_rows": (
        "sn BIGINT, samples ARRAY<DOUBLE>, sample_rate INT, channels INT",
        "tick BIGINT, channel INT, value DOUBLE",
        f"""SELECT sn + CAST(floor(place / channels) AS BIGINT) * CAST(floor({TICKS_PER_SECOND} / sample_rate) AS BIGINT), place % channels, value
        FROM (SELECT posexplode(slice(samples, 1, size(samples) - size(samples) % channels)) AS (place, value))""",
    ),
    "alarm_rows": (
        f"alarms ARRAY<{ALARM}>",
        "code BIGINT, severity INT, state INT, start_sn BIGINT",
        f"""SELECT coalesce(alarm.code, {PLACEHOLDER_CODE}), alarm.severity, alarm.state, alarm.start_sn
        FROM (SELECT explode_outer(alarms) AS alarm)""",
    ),
}


class BlockRows:
    """Blocks of segments (session, segment, min_sn, max_sn); further columns are ignored."""

    MINUTES, TICKS = 120, TICKS_PER_SECOND
    STRIP = 10_000  # most blocks of one call: Python makes a list of what a call gives

    def __init__(self) -> None:
        self.number = 0

    @staticmethod
    def analyze(segments: AnalyzeArgument) -> AnalyzeResult:
        missing = {"session", "segment", "min_sn", "max_sn"} - {f.name for f in segments.dataType.fields}
        if missing:
            raise ValueError(f"block_rows needs the columns {sorted(missing)}")
        fields = {f.name: f.dataType for f in segments.dataType.fields}
        schema = T.StructType([T.StructField("session", fields["session"]), T.StructField("segment", fields["segment"])])
        for name in ("num", "min_sn", "max_sn"):
            schema = schema.add(name, T.LongType())
        # strips are made behind the sort, so those of a segment come one after another
        last = f"greatest((CAST(max_sn AS BIGINT) - min_sn) div {60 * BlockRows.MINUTES * BlockRows.TICKS}L, 0L)"
        strips = f"explode(sequence(0L, {last}, {BlockRows.STRIP}L))"
        return AnalyzeResult(
            schema,
            partitionBy=[PartitioningColumn("session")],
            orderBy=[OrderingColumn("segment")],
            select=[*map(SelectedColumn, ("session", "segment", "min_sn", "max_sn")), SelectedColumn(strips, "first")],
        )

    def eval(self, row: T.Row) -> Iterator[tuple]:
        lo, hi = row["min_sn"], row["max_sn"]
        if lo is None or hi is None or hi <= lo:
            return iter(())
        count = max(round((hi - lo) / self.TICKS / 60.0 / self.MINUTES), 1)
        size = -(-(hi - lo) // count)
        session, segment = row["session"], row["segment"]
        places = range(lo, lo + count * size, size)[row["first"] : row["first"] + self.STRIP]
        numbers = range(self.number, self.number + len(places))
        self.number = numbers.stop
        # only the last blocks can reach beyond the segment
        ends = map(min, range(places.start + size - 1, places.stop + size - 1, size), repeat(hi))
        return zip(repeat(session), repeat(segment), numbers, places, ends)


def register(spark: SparkSession) -> None:
    """Make the functions above known to the session, in place of earlier ones of their names."""
    for name, (arguments, result, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    for name, (arguments, columns, body) in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({columns}) RETURN {body}")
    # blocks are many more than segments: they come back in Arrow batches, not as pickled rows
    spark.udtf.register("block_rows", F.udtf(BlockRows, useArrow=True))


def register_rows(spark: SparkSession, name: str, function: Callable, columns: str) -> None:
    """A user's function from the values of one row to any number of rows, as table function ``name``.

    The function is shipped to the executors and called once per row of the query
    that has it in its ``LATERAL`` clause.  It returns or yields tuples of ``columns``;
    none at all means no rows.
    """

    class Rows:
        def eval(self, *values):
            yield from function(*values) or ()

    spark.udtf.register(name, F.udtf(Rows, returnType=columns))


def register_feature(spark: SparkSession, name: str, function: Callable, returns: str = "double") -> None:
    """A user's function over one window of values, as scalar function ``name``.

    It gets a NumPy array per window and is called from Arrow batches; a null window
    gives null without a call.
    """
    import pandas as pd

    def batch(windows: pd.Series) -> pd.Series:
        return pd.Series([None if w is None else function(w) for w in windows])

    batch.__annotations__ = {"windows": pd.Series, "return": pd.Series}
    spark.udf.register(name, F.pandas_udf(batch, returns))
