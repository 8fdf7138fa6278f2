"""Device log files as a data source: filters on device and time reach the files.

``read_log_files`` gives the rows of ``logs_text.read_log_text``.  One file is one
partition (a gzip file cannot be split); a line that a pushed filter leaves out is
dropped before its fields are cut, and only Arrow batches of ``BATCH`` lines are held.
"""

from __future__ import annotations

import datetime as dt
import gzip
import io
import operator
import re
from dataclasses import dataclass
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds

from .logs_text import HEAD

FORMAT = "device_log"
BATCH = 8192
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
COMPARE = {
    ds.EqualTo: operator.eq,
    ds.GreaterThan: operator.gt,
    ds.GreaterThanOrEqual: operator.ge,
    ds.LessThan: operator.lt,
    ds.LessThanOrEqual: operator.le,
}
UTC = dt.timezone.utc


@dataclass
class LogFile(ds.InputPartition):
    path: str


class DeviceLog(ds.DataSource):
    """Options: ``path`` (file or folder), ``zone`` of the dates, ``head`` (pattern of a line's start)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "device_id bigint, at timestamp, fields array<string>, file string"

    def reader(self, schema):
        return DeviceLogReader(self.options)


class DeviceLogReader(ds.DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.zone = options.get("zone", "UTC")
        self.head = options.get("head", HEAD)
        self.tests = []  # (column, comparison, value)

    def pushFilters(self, filters):
        """Take comparisons of device and time with a value; the rest is left to Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if isinstance(f, ds.IsNotNull) and column in ("device_id", "at"):
                continue  # a row has both
            if isinstance(f, ds.In) and column == "device_id":
                self.tests.append((column, operator.contains, frozenset(f.value)))
            elif type(f) in COMPARE and (
                column == "device_id" or column == "at" and getattr(f.value, "tzinfo", None) is not None
            ):
                self.tests.append((column, COMPARE[type(f)], f.value))
            else:
                yield f

    def partitions(self):
        system, path = _resolved(self.path)
        found = system.get_file_info(path)
        if found.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if found.type == fs.FileType.File:
            return [LogFile(path)]
        inside = system.get_file_info(fs.FileSelector(path))
        names = [i.path for i in inside if i.type == fs.FileType.File and i.base_name[0] not in "._"]
        return [LogFile(n) for n in sorted(names)]

    def read(self, partition):
        if partition is None or partition.path is None:
            return
        system, _ = _resolved(self.path)
        schema = pa.schema(
            [("device_id", pa.int64()), ("at", pa.timestamp("us", "UTC")), ("fields", pa.list_(pa.string())), ("file", pa.string())]
        )
        with system.open_input_stream(partition.path, compression=None) as raw:
            stream = gzip.GzipFile(fileobj=raw) if partition.path.endswith(".gz") else raw
            lines = io.TextIOWrapper(stream, encoding="utf-8", errors="replace")
            rows = []
            for line in lines:
                row = self._row(line.rstrip("\n"))
                if row is not None:
                    rows.append((*row, partition.path))
                if len(rows) == BATCH:
                    yield _batch(rows, schema)
                    rows = []
            if rows:
                yield _batch(rows, schema)

    def _row(self, line: str):
        head, tab, rest = line.partition("\t")
        found = re.search(self.head, head) if tab else None
        if not found:
            return None
        device, at = int(found[1]), _moment(found[2], self.zone)
        if at is None:
            return None
        for column, compare, value in self.tests:
            own = device if column == "device_id" else at
            if not (compare(value, own) if compare is operator.contains else compare(own, value)):
                return None
        return device, at, [f.strip(" \t\n\v\f\r") for f in rest.split("\t")]


def _resolved(path: str):
    """File system and path in it, for a plain path or a URI any executor can reach."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


def _moment(text: str, zone: str):
    """A date such as ``03 Feb 2020 04:05:06`` in UTC, or None if there is no such moment."""
    day, month, year, clock = text.split(" ")
    try:
        local = dt.datetime(int(year), MONTHS.index(month) + 1, int(day), *map(int, clock.split(":")))
    except ValueError:
        return None
    return local.replace(tzinfo=ZoneInfo(zone)).astimezone(UTC)


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_log_files(spark: SparkSession, path: str, head_pattern: str = HEAD) -> DataFrame:
    """Rows (device_id, at, fields, file) of a log file or a folder of them.

    Comparisons of ``device_id`` and ``at`` with constants go down to the files.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DeviceLog)
    zone = spark.conf.get("spark.sql.session.timeZone")
    return spark.read.format(FORMAT).option("zone", zone).option("head", head_pattern).load(path)
