"""Ordered state machines on streams, driven by timers.

The forms in ``alarms`` and ``dropouts`` read and write the whole state of a series
with every batch.  Here the rows of a series that still wait are a list in the state
store which a batch only appends to, and an event-time timer says when the series is
due: at its first waiting row, when a window of it ends, or after its silence.  A series
without rows in a batch costs nothing until its timer fires.

State lies in RocksDB: set ``spark.sql.streaming.stateStore.providerClass`` to
``PROVIDER``.  Time to live of Spark's state counts processing time, which would make
results depend on how fast a stream is read; the silence timer takes its place.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..plans.export import NUMERICS
from . import alarms, dropouts
from .ordered import ORDER

# Fixed value: the store that timers and lists need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class OrderedSeries(StatefulProcessor):
    """Hands the rows of a series to a machine in order of (t, seq) once the watermark has passed them.

    A machine is a tuple; ``fresh`` is its first state and ``schema`` its type.
    """

    fresh: tuple
    schema: str
    columns: dict[str, str]
    out: list[str]

    def __init__(self, silence: str) -> None:
        self.silence = int(pd.Timedelta(silence) // pd.Timedelta("1ms"))

    def step(self, machine: tuple, rows: pd.DataFrame, watermark: int) -> tuple[tuple, list[tuple]]:
        """Take due rows; what is known by now comes out."""
        raise NotImplementedError

    def end(self, machine: tuple) -> list[tuple]:
        """What comes out when the series has ended."""
        raise NotImplementedError

    def last(self, machine: tuple) -> float:
        """Second of the last row taken."""
        raise NotImplementedError

    def next_end(self, machine: tuple) -> float | None:
        """Second at which something is due without a row, if any."""
        return None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.machine = handle.getValueState("machine", self.schema)
        self.waiting = handle.getListState("waiting", ", ".join(f"{c} {t}" for c, t in self.columns.items()))
        self.timer = handle.getValueState("timer", "at bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = math.inf
        for batch in rows:
            self.waiting.appendList(_tuples(batch, self.columns))
            first = min(first, float(batch["t"].min()))
        if math.isfinite(first):
            self._wake(first * 1000.0, timerValues.getCurrentWatermarkInMs(), sooner=True)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        watermark = timerValues.getCurrentWatermarkInMs()
        kept = pd.DataFrame(list(self.waiting.get()), columns=list(self.columns))
        kept = kept.sort_values(ORDER, kind="stable", ignore_index=True)
        past = kept["t"] * 1000.0 <= watermark
        ready, kept = kept[past], kept[~past]
        machine, rows = self.step(self.machine.get() or self.fresh, ready, watermark)
        silent_at = self.last(machine) * 1000.0 + self.silence
        if len(kept) == 0 and silent_at <= watermark:
            rows = rows + self.end(machine)
            self.machine.clear()
            self.waiting.clear()
        else:
            self.machine.update(machine)
            if len(ready):
                if len(kept):
                    self.waiting.put(_tuples(kept, self.columns))
                else:
                    self.waiting.clear()
            due = [kept["t"].iloc[0] * 1000.0 if len(kept) else silent_at]
            closing = self.next_end(machine)
            self._wake(min(due + ([closing * 1000.0] if closing is not None else [])), watermark)
        if rows:
            yield pd.DataFrame([(*key, *r) for r in rows], columns=self.out)

    def close(self) -> None:
        pass

    def _wake(self, at_ms: float, watermark: int, sooner: bool = False) -> None:
        """One timer per series; an earlier one takes its place."""
        at = max(math.ceil(at_ms), watermark) + 1
        set_to = self.timer.get()
        if set_to is not None:
            if sooner and set_to[0] <= at:
                return
            self.handle.deleteTimer(set_to[0])
        self.handle.registerTimer(at)
        self.timer.update((at,))


class AlarmSeries(OrderedSeries):
    """Leaky-bucket alarms against one limit."""

    fresh, schema = alarms.FRESH, "mode int, since double, start double, xx double, bucket double, last double"
    columns = {"t": "double", "seq": "bigint", "value": "double"}
    out = ["session", "param", "start", "stop", "xx", "bucket"]

    def __init__(self, silence: str, kind: str, limit: float) -> None:
        super().__init__(silence)
        self.kind, self.limit = kind, limit

    def step(self, machine, rows, watermark):
        classes = (alarms.reading_class(self.kind, v, self.limit) for v in rows["value"])
        return alarms.fold(machine, zip(rows["t"].tolist(), classes))

    def end(self, machine):
        return alarms.finish(machine, machine[5])

    def last(self, machine):
        return machine[5]


class DropoutSeries(OrderedSeries):
    """Merged dropouts."""

    fresh, schema = dropouts.FRESH, "last double, number bigint, opened double"
    columns = {"t": "double", "seq": "bigint", "sn": "bigint"}
    out = ["session", "param", "start", "stop"]

    def __init__(self, silence: str, rate: float, slop: float) -> None:
        super().__init__(silence)
        self.rate, self.slop = rate, slop

    def step(self, machine, rows, watermark):
        return dropouts.fold(machine, zip(rows["t"].tolist(), rows["sn"].tolist()), self.rate, self.slop)

    def end(self, machine):
        return dropouts.finish(machine)

    def last(self, machine):
        return machine[0]


class ExportSeries(OrderedSeries):
    """Windows of a session from the second of its first reading on, empty ones too."""

    fresh = (math.nan, 0, math.nan, [], [])
    schema = "t0 double, open bigint, last double, names array<string>, held array<double>"
    columns = {"t": "double", "seq": "bigint", "param": "string", "value": "double"}

    def __init__(self, silence: str, params: list[str], window: float) -> None:
        super().__init__(silence)
        self.params, self.window = params, window
        self.out = ["session", "window", "t", *[p.lower() for p in params]]

    def step(self, machine, rows, watermark):
        t0, at, last, names, held = machine[0], machine[1], machine[2], list(machine[3]), list(machine[4])
        done = []
        for t, param, value in zip(rows["t"].tolist(), rows["param"], rows["value"].tolist()):
            if math.isnan(t0):
                t0 = math.floor(t) * 1.0
            index = int((t - t0) // self.window)
            while at < index:
                done.append(self._cells(t0, at, names, held))
                at, names, held = at + 1, [], []
            names.append(param)
            held.append(value)
            last = t
        if names and (t0 + (at + 1) * self.window) * 1000.0 <= watermark:
            done.append(self._cells(t0, at, names, held))
            at, names, held = at + 1, [], []
        return (t0, at, last, names, held), done

    def end(self, machine):
        t0, at, last, names, held = machine
        count = math.ceil((math.ceil(last) + self.window - t0) / self.window)
        done = [self._cells(t0, at, names, held)] if at < count else []
        return done + [self._cells(t0, i, [], []) for i in range(at + 1, count)]

    def last(self, machine):
        return machine[2]

    def next_end(self, machine):
        return machine[0] + (machine[1] + 1) * self.window if machine[3] else None

    def _cells(self, t0: float, at: int, names: list, held: list) -> tuple:
        names, held = np.array(names, dtype=object), np.array(held, dtype=float)
        return at, t0 + at * self.window, *[text_of(held[names == p]) for p in self.params]


def text_of(values: np.ndarray) -> str | None:
    """Median of the valid readings, else their state; none without readings."""
    if len(values) == 0:
        return None
    valid = values[values > -1]
    if len(valid):
        return str(int(np.median(valid)))
    if ((values < 0) & (values > -4)).any():
        return "XX"
    return "++" if (values == -4).any() else "--"


def _tuples(rows: pd.DataFrame, columns: Iterable[str]) -> list[tuple]:
    return list(zip(*[rows[c].tolist() for c in columns]))


def _run(readings: DataFrame, keys: list[str], machine: OrderedSeries, out: str, lateness: str) -> DataFrame:
    rows = readings if "seq" in readings.columns else readings.withColumn("seq", F.lit(0).cast("bigint"))
    rows = rows.select(*keys, "ts", *[F.col(c).cast(t).alias(c) for c, t in machine.columns.items()])
    return (
        rows.where(F.col("t").isNotNull())
        .withWatermark("ts", lateness)
        .groupBy(*keys)
        .transformWithStateInPandas(machine, out, "Append", "EventTime")
    )


def timed_alarms(
    readings: DataFrame, kind: str, limit: float, silence: str = "1 hour", lateness: str = "1 minute"
) -> DataFrame:
    """Alarms of a stream (session, param, ts, t, value, maybe seq), as ``alarm_stream`` gives them."""
    return _run(readings, ["session", "param"], AlarmSeries(silence, kind, limit), alarms.OUT, lateness)


def timed_dropouts(
    readings: DataFrame, rate: float, slop: float = 0.1, silence: str = "1 hour", lateness: str = "1 minute"
) -> DataFrame:
    """Dropouts of a stream (session, param, ts, t, sn, value, maybe seq), as ``dropout_stream`` gives them."""
    return _run(readings, ["session", "param"], DropoutSeries(silence, rate, slop), dropouts.OUT, lateness)


def timed_export(
    readings: DataFrame,
    params: list[str] | None = None,
    window: float = 15.0,
    silence: str = "1 hour",
    lateness: str = "1 minute",
) -> DataFrame:
    """Windows of each session (session, window, t, one text per series), as the batch export lays them.

    A window with readings comes out when the watermark passes its end; empty ones
    come with the next that is not, and at the end of the session up to its last
    second.  A session that goes on after its silence starts anew.
    """
    params = params or NUMERICS
    out = ", ".join(["session bigint", "window bigint", "t double", *[f"{p.lower()} string" for p in params]])
    wanted = readings.where(F.col("param").isin(*params))
    return _run(wanted, ["session"], ExportSeries(silence, params, window), out, lateness)
