"""Leaky-bucket alarms on a stream of readings."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ..model import LEAK_PER_SECOND
from .ordered import due, wake_at

NONE, NORM, ALARM, XX = 0, 1, 2, 3
OUT = "session bigint, param string, start double, stop double, xx double, bucket double"
STATE = (
    "mode int, since double, start double, xx double, bucket double, last double,"
    " t array<double>, seq array<bigint>, value array<double>"
)
FRESH = (NONE, 0.0, math.nan, 0.0, 0.0, -math.inf)


def reading_class(kind: str, value: float, limit: float) -> int:
    """Class of a reading against a limit; NONE for codes in no class."""
    if value in (-1.0, -2.0, -3.0):
        return XX
    if kind == "HIGH":
        if value >= limit or value == -4:
            return ALARM
        return NORM if value >= 0 or value == -5 else NONE
    if 0 <= value <= limit or value == -5:
        return ALARM
    return NORM if value > limit else NONE


def fold(state: tuple, rows: Iterable[tuple[float, int]]) -> tuple[tuple, list[tuple]]:
    """Advance one series by (t, class) rows in time order; closed alarms come out."""
    mode, since, start, xx, bucket, last = state
    closed = []
    for t, cls in rows:
        last = t
        if cls in (NONE, mode):
            continue
        open_ = not math.isnan(start)
        if mode == NORM:
            bucket = max(0.0, bucket - LEAK_PER_SECOND * (t - since))
        elif mode == XX and open_:
            xx += t - since
        if cls == ALARM and not open_:
            start, xx = t, 0.0
        elif cls == NORM and open_:
            bucket += t - start - xx
            closed.append((start, t, xx, bucket))
            start = math.nan
        mode, since = cls, t
    return (mode, since, start, xx, bucket, last), closed


def finish(state: tuple, end: float) -> list[tuple]:
    """The alarm a series ends in, if any."""
    mode, since, start, xx, bucket, _ = state
    if math.isnan(start):
        return []
    xx += end - since if mode == XX else 0.0
    return [(start, end, xx, bucket + end - start - xx)]


def alarm_stream(
    readings: DataFrame, kind: str, limit: float, silence: str = "1 hour", lateness: str = "1 minute"
) -> DataFrame:
    """Alarms of a stream (session, param, ts, t, value, maybe seq) against one limit.

    The state of a series is six numbers and its rows of the last ``lateness``,
    which wait for the watermark and are then taken in order of (t, seq).  An alarm
    comes out when a normal reading closes it, or at the last reading of a series
    silent for ``silence`` in event time.
    """
    wait = pd.Timedelta(silence) // pd.Timedelta("1ms")

    def advance(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        kept = tuple(state.get) if state.exists else (*FRESH, [], [], [])
        now, waiting = kept[:6], dict(zip(("t", "seq", "value"), map(list, kept[6:])))
        silent = state.hasTimedOut and not waiting["t"]
        ready, waiting = due(waiting, [] if state.hasTimedOut else batches, state.getCurrentWatermarkMs())
        now, rows = fold(now, ((t, reading_class(kind, v, limit)) for t, v in zip(ready["t"], ready["value"])))
        if silent:
            rows = finish(now, now[5])
            state.remove()
        else:
            state.update((*now, waiting["t"], waiting["seq"], waiting["value"]))
            last = now[5] if math.isfinite(now[5]) else 0.0
            state.setTimeoutTimestamp(wake_at(waiting, last, int(wait), state.getCurrentWatermarkMs()))
        yield pd.DataFrame(
            [(*key, *r) for r in rows], columns=["session", "param", "start", "stop", "xx", "bucket"]
        )

    return (
        readings.withWatermark("ts", lateness)
        .groupBy("session", "param")
        .applyInPandasWithState(advance, OUT, STATE, "append", "EventTimeTimeout")
    )
