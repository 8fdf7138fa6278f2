"""Times, zones and time-window arguments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def local_time(unix_seconds: Column, zone: Column | str) -> Column:
    """Wall clock of the site at a unix time."""
    utc = F.timestamp_micros((unix_seconds.cast("double") * 1_000_000).cast("bigint"))
    return F.from_utc_timestamp(utc, zone)


def local_text(unix_seconds: Column, zone: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(local_time(unix_seconds, zone), pattern)


def unix_time(text: Column, zone: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Unix seconds of a wall-clock text; null when it does not parse."""
    return F.unix_micros(F.to_utc_timestamp(F.try_to_timestamp(text, F.lit(pattern)), zone)) / 1_000_000


def weekday(local: Column) -> Column:
    """Monday is 0."""
    return F.weekday(local)


# Plausible range of a packet time in milliseconds.
EARLIEST_MS, LATEST_MS = 100_000, 4_070_937_600_000


def repaired_ms(tm: Column, document_tm: Column) -> Column:
    """A missing or impossible packet time becomes the document's."""
    good = (tm >= EARLIEST_MS) & (tm <= LATEST_MS)
    return F.when(good, tm).otherwise(document_tm)


def epoch_ms(iso: Column) -> Column:
    """Milliseconds of an ISO text in UTC, null when empty."""
    plain = F.regexp_replace(F.regexp_replace(iso, "T", " "), "Z", "")
    parsed = F.try_to_timestamp(F.when(F.length(plain) > 0, plain))
    return F.unix_millis(parsed)


def window_arguments(start=None, stop=None, zone: str | None = None):
    """Check and convert a time window to unix seconds.

    Text and naive datetimes need a zone; start and stop must be the same kind.
    """
    from zoneinfo import ZoneInfo

    if start is not None and stop is not None:
        number = (int, float)
        if isinstance(start, number) != isinstance(stop, number) or (
            not isinstance(start, number) and type(start) is not type(stop)
        ):
            raise ValueError("start and stop must be the same kind")

    def convert(value):
        if value is None or isinstance(value, (int, float)):
            return value
        if zone is None and not (isinstance(value, dt.datetime) and value.tzinfo):
            raise ValueError("a time given as text needs a zone")
        if isinstance(value, str):
            value = dt.datetime.strptime(value, "%Y-%m-%d %H:%M:%S")
        if value.tzinfo is None:
            value = value.replace(tzinfo=ZoneInfo(zone))
        return value.timestamp()

    return convert(start), convert(stop)


def in_window(t: Column, start=None, stop=None) -> Column:
    keep = F.lit(True)
    if start is not None:
        keep = keep & (t >= start)
    if stop is not None:
        keep = keep & (t <= stop)
    return keep
