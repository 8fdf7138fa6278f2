"""Result tables: re-runnable writes, upserts and CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..session import durable


def replace_partitions(df: DataFrame, path: str, by: list[str], covered: DataFrame | None = None) -> None:
    """Write results so that a re-run replaces exactly the partitions it covers.

    ``covered`` lists the partitions of the run; one of them that gets no row
    loses the rows it had.
    """
    if covered is not None:
        df = durable(df)
        emptied = covered.select(*by).distinct().join(df.select(*by).distinct(), by, "left_anti")
        _drop_partitions(df.sparkSession, path, by, emptied)
    (
        df.repartition(*by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def _drop_partitions(spark: SparkSession, path: str, by: list[str], emptied: DataFrame) -> None:
    """Delete partition folders; their number is that of the partitions of one run."""
    jvm = spark._jvm
    name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for row in emptied.toLocalIterator():
        folder = "/".join(name(c, None if row[c] is None else str(row[c])) for c in by)
        files.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}"), True)


def replaced(old: DataFrame, fresh: DataFrame, sessions: DataFrame) -> DataFrame:
    """Rows of a result table after a re-run: those of the given sessions go,
    the fresh ones come in."""
    kept = old.join(sessions.select("session").distinct(), "session", "left_anti")
    return fresh.unionByName(kept)


def replace_sessions(df: DataFrame, path: str, sessions: DataFrame, buckets: int = 256) -> None:
    """Replace the rows of the given sessions in a result table bucketed by session.

    Rows of other sessions in the touched buckets are read back, kept and
    written with the new ones; buckets without a listed session stay untouched,
    and a touched bucket that is left without rows is deleted.
    """
    spark = df.sparkSession
    bucket = F.pmod(F.hash("session"), F.lit(buckets)).alias("bucket")
    fresh = df.select("*", bucket)
    touched = sessions.select(bucket).distinct()
    old = _read(spark, path)
    if old is not None:
        old = old.join(F.broadcast(touched), "bucket", "left_semi")
        # the table is read and written, so its rows are set down in between
        fresh = durable(replaced(old, fresh, sessions))
        _drop_partitions(spark, path, ["bucket"], touched.join(fresh.select("bucket").distinct(), "bucket", "left_anti"))
    (
        fresh.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket")
        .parquet(path)
    )


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, None if there is none yet; any other trouble is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def upserted(existing: DataFrame, fresh: DataFrame, keys: list[str], defaults: dict | None = None) -> DataFrame:
    """Existing rows with the columns of ``fresh`` replaced, new keys added.

    Keys match null-safe; columns that a new row lacks take ``defaults``.
    """
    given = [c for c in fresh.columns if c not in keys]
    a = existing.alias("a")
    b = fresh.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in given], F.lit(True).alias("_hit")
    )
    on = None
    for k in keys:
        c = F.col(f"a.{k}").eqNullSafe(F.col(f"_k_{k}"))
        on = c if on is None else on & c
    joined = a.withColumn("_old", F.lit(True)).join(b, on, "full")
    cols = []
    for c in existing.columns:
        if c in keys:
            cols.append(F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_k_{c}")).alias(c))
        elif c in given:
            cols.append(F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c))
        else:
            value = F.lit((defaults or {}).get(c)).cast(existing.schema[c].dataType)
            cols.append(F.when(F.col("_old"), F.col(c)).otherwise(value).alias(c))
    return joined.select(*cols)


def flat(df: DataFrame) -> DataFrame:
    """Columns as CSV can hold them: arrays are joined with blanks."""
    return df.select(
        *[
            F.array_join(F.col(f.name).cast("array<string>"), " ").alias(f.name)
            if f.dataType.typeName() == "array"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header, one file per partition."""
    flat(df).write.mode(mode).option("header", True).csv(path)
