"""Metadata documents of which not every key is known, kept as VARIANT."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys whose entries unite when documents are merged.
MAPS, SETS = ("ARRAYS",), ("DEVICES",)


def parsed(df: DataFrame, column: str = "document") -> DataFrame:
    """JSON text as VARIANT; text that is no JSON, or repeats a key of an object, gives null."""
    return df.withColumn(column, F.try_parse_json(F.col(column)))


def field(column: str, path: str, kind: str) -> Column:
    """A value of a document by its path (``$.a.b[0]``); null where it is missing or of another kind."""
    return F.try_variant_get(F.col(column), path, kind)


def _entries(documents: DataFrame, column: Column, outer: bool = False) -> DataFrame:
    spread = documents.sparkSession.tvf
    return documents.lateralJoin((spread.variant_explode_outer if outer else spread.variant_explode)(column.outer()))


def merged_documents(
    partials: DataFrame,
    keys: Sequence[str] = ("session", "block"),
    order: str = "seq",
    document: str = "document",
    maps: Sequence[str] = MAPS,
    sets: Sequence[str] = SETS,
) -> DataFrame:
    """Fold partial documents into one per ``keys``: (keys, document, unread).

    A later value (by ``order``) replaces an earlier one, whatever its kind, null included; keys nobody
    foresaw are kept.  Entries of ``maps`` are replaced one by one, members of
    ``sets`` unite, numbers before other values; both are always there, if empty.
    A document that merges into an existing one is a partial, too, with a lower
    ``order``.  Of values of one place in the order the one with the greater text
    wins.  Null and unreadable documents are counted in ``unread``; anything but an
    object, and a map or set of another kind, adds nothing.

    Documents are taken apart first, so the values of a block with very many
    partials are reduced before they are shuffled; only what is left of a block is put together.
    """
    df = partials.select(*keys, F.col(order).alias("_seq"), F.col(document).alias("_doc"))
    top = _entries(df, F.col("_doc"), outer=True).select(
        *keys, "_seq", F.col("_doc").isNull().alias("_bad"), F.col("key").alias("_key"), F.col("value").alias("_value")
    )
    united = [*maps, *sets]
    top = top.withColumn("_inner", F.when(F.col("_key").isin(*united), F.col("_value")) if united else F.lit(None).cast("variant"))
    place = F.when(F.col("_key").isin(*maps), F.col("key")) if maps else F.lit(None).cast("string")
    if sets:
        member = F.when(F.col("key").isNull(), F.to_json("value"))
        place = F.when(F.col("_key").isin(*sets), member).otherwise(place)
    rows = _entries(top, F.col("_inner"), outer=True).select(
        *keys, "_seq", "_bad", "_key", place.alias("_place"),
        F.when(F.col("_key").isin(*united), F.col("value")).otherwise(F.col("_value")).alias("_value"),
    )
    last = rows.groupBy(*keys, "_key", "_place").agg(
        F.max_by("_value", F.struct("_seq", F.to_json("_value"))).alias("_value"),
        F.count_if("_bad").alias("_bad"),
    )

    def gathered(condition: Column, entry: Column) -> Column:
        return F.collect_list(F.when(condition, entry))

    def as_object(entries: Column) -> Column:
        return F.call_function("to_variant_object", F.map_from_entries(entries))

    plain = F.col("_key").isNotNull() & ~F.col("_key").isin(*united)
    there = lambda k: (F.col("_key") == k) & F.col("_place").isNotNull()
    number = F.try_variant_get("_value", "$", "double")
    out = last.groupBy(*keys).agg(
        gathered(plain, F.struct(F.col("_key").alias("key"), F.col("_value").alias("value"))).alias("_plain"),
        *[
            gathered(there(k), F.struct(F.col("_place").alias("key"), F.col("_value").alias("value"))).alias(f"_m{i}")
            for i, k in enumerate(maps)
        ],
        *[
            gathered(there(k), F.struct(number.isNull().alias("a"), number.alias("n"), F.col("_place").alias("p"))).alias(f"_s{i}")
            for i, k in enumerate(sets)
        ],
        F.sum("_bad").alias("unread"),
    )
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    members = lambda c: F.transform(F.array_sort(c), lambda s: F.parse_json(s["p"]))
    fixed = [pair(k, as_object(F.col(f"_m{i}"))) for i, k in enumerate(maps)]
    fixed += [pair(k, F.call_function("to_variant_object", members(F.col(f"_s{i}")))) for i, k in enumerate(sets)]
    entries = F.concat("_plain", F.array(*fixed)) if fixed else F.col("_plain")
    return out.select(*keys, as_object(entries).alias(document), "unread")


def document_keys(documents: DataFrame, document: str = "document", known: Sequence[str] = ()) -> DataFrame:
    """Keys at the top of documents other than the ``known``: how many have them and the kind of all their values."""
    rows = _entries(documents.select(F.col(document).alias("_doc")), F.col("_doc")).where(F.col("key").isNotNull())
    if known:
        rows = rows.where(~F.col("key").isin(*known))
    return rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("documents"), F.schema_of_variant_agg("value").alias("kind")
    )


def listed_names(jobs: DataFrame, document: str = "document", path: str = "$.files", like: str = "%meta%") -> DataFrame:
    """File names that documents list at ``path``; members that are no text are left out."""
    names = F.try_variant_get(F.col(document), path, "array<variant>")
    name = F.when(F.schema_of_variant("_v") == "STRING", F.try_variant_get("_v", "$", "string"))
    return (
        jobs.select(F.explode(names).alias("_v")).select(name.alias("name")).where(F.col("name").like(like)).distinct()
    )


def pending_in_documents(index: DataFrame, document: str = "document", path: str = "$.blocks") -> DataFrame:
    """Blocks that documents list at ``path``, per status; a document without the list has none."""
    listed = F.size(F.try_variant_get(F.col(document), path, "array<variant>"))
    return index.groupBy("status").agg(F.sum(F.coalesce(F.greatest(listed, F.lit(0)), F.lit(0))).alias("blocks"))
