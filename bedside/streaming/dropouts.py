"""Dropouts on a stream of readings."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .ordered import due, wake_at

FRESH = (-1.0, -1, -1.0)
OUT = "session bigint, param string, start double, stop double"
STATE = "last double, number bigint, opened double, t array<double>, seq array<bigint>, sn array<bigint>"


def fold(state: tuple, rows: Iterable[tuple[float, int]], rate: float, slop: float) -> tuple[tuple, list[tuple]]:
    """Advance one series by (t, sn) rows in time order; closed dropouts come out."""
    last, sn, opened = state
    closed = []
    for t, n in rows:
        reset = last < 0 or n < sn
        gap = not reset and t - last > rate + slop
        if opened >= 0 and not gap:
            closed.append((opened, last))
            opened = -1.0
        if gap and opened < 0:
            opened = last + rate
        last, sn = float(t), int(n)
    return (last, sn, opened), closed


def finish(state: tuple) -> list[tuple]:
    """The dropout a series ends in, if any."""
    last, _, opened = state
    return [(opened, last)] if opened >= 0 else []


def dropout_stream(
    readings: DataFrame, rate: float, slop: float = 0.1, lateness: str = "1 minute", silence: str = "1 hour"
) -> DataFrame:
    """Merged dropouts of a stream (session, param, ts, t, sn, value, maybe seq).

    A dropout opens one update after the last reading and comes out with the
    first reading that is on time again, with a reset, or when the series is
    silent for ``silence`` in event time, which also frees its state.  Rows wait
    for the watermark and are taken in order of (t, seq).
    """
    wait = pd.Timedelta(silence) // pd.Timedelta("1ms")

    def advance(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        kept = tuple(state.get) if state.exists else (*FRESH, [], [], [])
        now, waiting = kept[:3], dict(zip(("t", "seq", "sn"), map(list, kept[3:])))
        silent = state.hasTimedOut and not waiting["t"]
        ready, waiting = due(waiting, [] if state.hasTimedOut else batches, state.getCurrentWatermarkMs())
        now, rows = fold(now, zip(ready["t"], ready["sn"]), rate, slop)
        if silent:
            rows = rows + finish(now)
            state.remove()
        else:
            state.update((*now, waiting["t"], waiting["seq"], waiting["sn"]))
            state.setTimeoutTimestamp(wake_at(waiting, max(now[0], 0.0), int(wait), state.getCurrentWatermarkMs()))
        yield pd.DataFrame([(*key, *r) for r in rows], columns=["session", "param", "start", "stop"])

    return (
        readings.withWatermark("ts", lateness)
        .groupBy("session", "param")
        .applyInPandasWithState(advance, OUT, STATE, "append", "EventTimeTimeout")
    )
