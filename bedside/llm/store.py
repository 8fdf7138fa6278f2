"""Helpers that several corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word is a maximal run of anything but space and the five ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    Later stages start from files that every executor sees, so neither a lost
    executor nor a second use of the table repeats the work before it.
    """
    path = f"{shared_folder(df.sparkSession)}/corpus/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, anything else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def column(name: str) -> Column:
    """A column by its plain name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, out of the way of working columns."""
    return F.struct(*[column(c) for c in df.columns])


def spread(df: DataFrame, row: str, names: list[str]) -> DataFrame:
    """The columns that :func:`whole_row` put away, and nothing else."""
    return df.select(*[F.col(row).getField(c).alias(c) for c in names])


#: Rows of text that go to a Python worker at once; pages and documents are long, so Spark's 10,000 are many.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Keep the batches between Spark and Python workers to ``BATCH_ROWS`` rows, unless they are smaller already."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


_HELD: dict[str, Callable[[], None]] = {}


def hold(owner: str, forget: Callable[[], None]) -> None:
    """Say that a worker now remembers things for ``owner``.

    Workers are used again by later stages; what one remembers for another
    operator goes, so that its memory is bounded by one of them.
    """
    for other in [o for o in _HELD if o != owner]:
        _HELD.pop(other)()
    _HELD[owner] = forget


def portions(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches where the bytes of a text column pass ``limit``; a longer single text stays whole."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = [n or 0 for n in pc.binary_length(texts).to_pylist()]
        begin, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        if begin < len(sizes):
            yield batch.slice(begin)
