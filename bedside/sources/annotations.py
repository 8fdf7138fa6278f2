"""Annotations: append-only versions, current view and tag search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_versions(
    changes: DataFrame, current: DataFrame | None, tags: DataFrame, source: str
) -> DataFrame:
    """Versions to append for inserts and updates.

    ``changes``: id, session, block, start_time, stop_time, notes, data, tags,
    version, deleted.  Tags must exist and a ``source:`` tag is added when there
    is none; fields left null keep their value and a given tag set replaces the
    old one.
    """
    known = (
        changes.select("id", "version", F.explode_outer("tags").alias("tag"))
        .join(tags.select("tag").distinct().withColumn("_known", F.lit(True)), "tag", "left")
        .groupBy("id", "version")
        .agg(F.bool_and(F.col("tag").isNull() | F.coalesce("_known", F.lit(False))).alias("_valid"))
    )
    df = changes.join(known, ["id", "version"]).where("_valid").drop("_valid")
    if current is not None:
        old = current.select(
            "id", *[F.col(c).alias(f"_o_{c}") for c in ("session", "block", "start_time", "stop_time", "notes", "data", "tags")]
        )
        df = df.join(old, "id", "left")
        for c in ("session", "block", "start_time", "stop_time", "notes", "data", "tags"):
            df = df.withColumn(c, F.coalesce(c, f"_o_{c}")).drop(f"_o_{c}")
    sourced = F.exists("tags", lambda t: t.startswith("source:"))
    own = F.array(F.lit(f"source:{source}"))
    with_source = F.when(F.coalesce(sourced, F.lit(False)), F.col("tags")).otherwise(
        F.concat(F.coalesce("tags", F.array().cast("array<string>")), own)
    )
    return df.withColumn("tags", F.array_sort(F.array_distinct(with_source)))


def current_view(versions: DataFrame, key: str = "id") -> DataFrame:
    """Latest version of each annotation that is not deleted.

    The latest row is an aggregate, so an annotation with very many versions is
    reduced before the shuffle.
    """
    rest = [c for c in versions.columns if c != key]
    latest = versions.groupBy(key).agg(F.max_by(F.struct(*rest), "version").alias("_v"))
    return latest.select(key, "_v.*").where(~F.coalesce("deleted", F.lit(False)))


def with_all_tags(
    annotations: DataFrame, annotation_tags: DataFrame, tags: list[str] | None = None, **equal
) -> DataFrame:
    """Annotations that carry every given tag (and match the given fields).

    At least one condition is needed.  Tags come as a sorted array, rows in
    order of their start.
    """
    wanted = sorted(set(tags or []))
    if not wanted and not equal:
        raise ValueError("at least one condition is needed")
    df = annotations
    for name, value in equal.items():
        df = df.where(F.col(name) == F.lit(value))
    if wanted:
        having = (
            annotation_tags.where(F.col("tag").isin(*wanted))
            .groupBy("annid")
            .agg(F.countDistinct("tag").alias("_n"))
            .where(F.col("_n") == len(wanted))
        )
        df = df.join(having, df["id"] == having["annid"], "left_semi")
    every = (
        annotation_tags.distinct().groupBy("annid").agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    )
    return df.join(every, df["id"] == every["annid"], "left").drop("annid").orderBy("start_time", "id")


def annotated_blocks(
    annotations: DataFrame, annotator: str, code: int | None = None, since=None
) -> DataFrame:
    """Distinct (session, block) an annotator has worked on."""
    df = annotations.where(F.col("annotator") == annotator)
    if code is not None:
        df = df.where(F.col("code") == code)
    if since is not None:
        df = df.where(F.col("created") >= F.lit(since).cast("timestamp"))
    return df.select("session", "block").distinct()


def session_annotations(annotations: DataFrame, types: DataFrame, annotator: str, session: int, block: int | None = None) -> DataFrame:
    """Annotations of one annotator in a session with the name of their type."""
    df = annotations.where((F.col("annotator") == annotator) & (F.col("session") == session))
    if block is not None:
        df = df.where(F.col("block") == block)
    return df.join(types.select(F.col("id").alias("type_id"), "name"), "type_id", "left")
