"""Session helpers shared by the operators."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build(cores: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bedside")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # small tables: keep all cores busy instead of merging partitions up to 1 MB
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of constants as part of the plan.

    Its size is known when the query is planned, so joins with it are
    broadcast without a hint and no Python worker is needed to read it.
    """
    fields = T.StructType.fromDDL(schema).fields
    cells = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*cells)))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and every executor see: ``spark.checkpoint.dir``.

    Only a session inside one machine's JVM (``local[...]``, as in tests) may
    leave it unset and gets a folder of its own; on a cluster that is an error,
    because other machines would not see the files.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", "") or context.getConf().get("spark.checkpoint.dir", "")
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = _LOCAL.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="bedside-")
        _LOCAL[context.applicationId] = folder
    return folder.rstrip("/")


_LOCAL: dict[str, str] = {}


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
