"""Device log search."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import PLACEHOLDER, all_of, any_of, rebuilt_message
from ..operators.ranges import point_join
from ..operators.runs import islands
from .template_index import candidates


def matching_templates(
    templates: DataFrame, terms: str | Sequence[str], index: DataFrame | None = None
) -> DataFrame:
    """Templates that fit a search term: (id, term, contents).

    A template fits when it matches the term from its start, when the term
    matches it, or when it matches the term and a blank.  ``contents`` are the
    captured groups, null where there are none.  Terms are laid out next to
    each template, so no join is needed.  With an ``index`` of the templates (see
    :mod:`bedside.plans.template_index`) a term is only tried on those it has pieces in
    common with; the result is the same.
    """
    terms = [t for t in (terms.split(",") if isinstance(terms, str) else terms) if t]
    if index is None:
        df = templates.withColumn("term", F.explode(F.array(*[F.lit(t) for t in terms]).cast("array<string>")))
    else:
        df = templates.join(candidates(index, templates, terms), "id")
    df = df.withColumn("_p", F.concat(F.lit("^"), "cipher"))
    blank = F.concat("term", F.lit(" "))
    plain = F.rlike("term", F.col("_p"))
    turned = F.rlike("_p", F.col("term"))
    df = df.where(plain | turned | F.rlike(blank, F.col("_p")))
    subject = F.when(plain | turned, F.col("term")).otherwise(blank)
    groups = F.size(F.regexp_extract_all("cipher", F.lit(PLACEHOLDER), F.lit(0)))
    captured = F.transform(
        F.sequence(F.lit(1), groups), lambda i: F.call_function("regexp_extract", subject, F.col("_p"), i)
    )
    hit = (groups > 0) & F.rlike(subject, F.col("_p"))
    return df.select("id", "cipher", "term", F.when(hit, captured).alias("contents"))


def _cells(values: Sequence[str] | None) -> list[tuple[Column, str]]:
    return [(F.get("message_content", k), v) for k, v in enumerate(values or []) if v]


def with_contents(values: Sequence[str] | None) -> list[Column]:
    """Conditions for a line to hold the contents: a single one anywhere, several each in its place."""
    if values and len(values) == 1:
        return [F.array_contains("message_content", values[0])]
    return [c == v for c, v in _cells(values)]


def without_contents(values: Sequence[str] | None) -> list[Column]:
    if values and len(values) == 1:
        return [~F.array_contains("message_content", values[0])]
    return [c != v for c, v in _cells(values)]


def template_filter(matches: Sequence[tuple[int, Sequence[str] | None]], include: bool) -> Column:
    """Condition of the matched templates on (cipher_id, message_content).

    Include: any template with its contents.  Exclude: no template, and none of
    their contents.
    """

    contents = with_contents if include else without_contents
    own = lambda x: (F.col("cipher_id") == x) if include else (F.col("cipher_id") != x)
    each = [all_of([own(x), *contents(values)]) for x, values in matches]
    if include:
        return any_of(each)
    return all_of(each)


def with_templates(logs: DataFrame, matches: DataFrame) -> DataFrame:
    """Lines of any matched template (id, contents) that hold its contents."""
    m = matches.select(F.col("id").alias("_id"), F.col("contents").alias("_c"))
    place = F.sequence(F.lit(0), F.size("_c") - 1)
    each = F.forall(
        place,
        lambda k: F.coalesce(F.get("_c", k), F.lit("")).isin("")
        | F.get("message_content", k).eqNullSafe(F.get("_c", k)),
    )
    holds = (
        F.when(F.coalesce(F.size("_c"), F.lit(0)) <= 0, F.lit(True))
        .when(F.size("_c") == 1, F.array_contains("message_content", F.get("_c", 0)))
        .otherwise(each)
    )
    return logs.join(m, (logs["cipher_id"] == m["_id"]) & holds, "left_semi")


def without_templates(logs: DataFrame, matches: DataFrame) -> DataFrame:
    """Lines of no matched template (id, contents) that hold none of the contents.

    Templates, of which the dictionary may have any number, are an anti join.  Contents
    are parts of the search terms, so there are few of them however many templates match.
    """
    contents = [r["contents"] for r in matches.select("contents").distinct().collect()]
    if not contents:
        return logs
    ids = matches.select(F.col("id").alias("_id")).distinct()
    kept = logs.where("cipher_id is not null").join(ids, F.col("cipher_id") == F.col("_id"), "left_anti")
    return kept.where(all_of([c for values in contents for c in without_contents(values)]))


def months(first: dt.datetime, last: dt.datetime) -> Column:
    """Partition condition for the months a range touches (year, month columns)."""
    place = F.col("year") * 12 + F.col("month")
    return place.between(first.year * 12 + first.month, last.year * 12 + last.month)


def time_range(start: str, stop: str | None = None, margin_minutes: int = 10):
    """Bounds of a search; without a stop it is ten minutes either side, ends excluded."""

    def parse(text: str) -> dt.datetime:
        for pattern in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d"):
            try:
                return dt.datetime.strptime(text, pattern)
            except ValueError:
                continue
        raise ValueError(f"not a time: {text}")

    first = parse(start)
    if stop:
        return first, parse(stop), True
    margin = dt.timedelta(minutes=margin_minutes)
    return first - margin, first + margin, False


def device_stretches(blocks: DataFrame) -> DataFrame:
    """Consecutive blocks of a session on one device as one time range."""
    return islands(blocks, ["session"], ["block"], "device_id", "unix_start", "unix_stop")


def logs_of_sessions(logs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Log lines of the devices each session was on, while it was on them.

    A line comes once per stretch that holds it; equal lines all stay.
    """
    stretches = device_stretches(blocks).withColumnRenamed("stop", "end")
    at = F.unix_micros("datetime_sent") / 1_000_000
    pairs = point_join(
        logs.where(F.col("device_id").isNotNull()), stretches.select("session", "device_id", "start", "end"),
        ["device_id"], at, (F.col("start"), F.col("end")), 86_400.0,
    )
    return pairs.select("b.session", "a.*")


def readable(logs: DataFrame, templates: DataFrame, levels: DataFrame, device_types: DataFrame) -> DataFrame:
    """Log lines with level and device type as text and the message rebuilt."""
    named = logs.join(
        templates.select(F.col("id").alias("cipher_id"), F.col("cipher").alias("_template")), "cipher_id", "left"
    )
    for dimension, column in ((levels, "log_level"), (device_types, "device_type")):
        named = named.join(
            dimension.select(F.col("code").alias(column), F.col("cipher").alias(f"_{column}")), column, "left"
        ).withColumn(column, F.coalesce(f"_{column}", F.col(column).cast("string"))).drop(f"_{column}")
    return named.withColumn(
        "message", rebuilt_message(F.col("_template"), F.col("message_content"))
    ).drop("_template")


def search(
    logs: DataFrame,
    templates: DataFrame,
    levels: DataFrame,
    device_types: DataFrame,
    start: str | None = None,
    stop: str | None = None,
    site: str | None = None,
    device: int | None = None,
    lid: int | None = None,
    level: int | None = None,
    device_type: int | None = None,
    message: str | None = None,
    without: str | None = None,
    session: int | None = None,
    blocks: DataFrame | None = None,
    order_by: str = "datetime_sent",
    index: DataFrame | None = None,
) -> DataFrame:
    """Search the logs by place, time, device, level, class and message.

    One scan with everything composed into its filter; site, year and month
    prune partitions where the logs are stored by them.  Lines of the wanted
    templates are kept by a semi join with the message dictionary, those of unwanted
    ones dropped by an anti join.  With
    ``blocks`` the search is by session: one, or all of them.  ``index`` spares a large
    dictionary the trial of every template.
    """
    df = logs
    if blocks is not None:
        own = blocks if session is None else blocks.where(F.col("session") == session)
        df = logs_of_sessions(logs, own)
    if start is not None:
        first, last, closed = time_range(start, stop)
        if {"year", "month"} <= set(df.columns):
            df = df.where(months(first, last))
        at, lo, hi = F.col("datetime_sent"), F.lit(first), F.lit(last)
        df = df.where(at.between(lo, hi) if closed else (at > lo) & (at < hi))
    for column, value in (
        ("site", site), ("device_id", device), ("lid", lid), ("log_level", level), ("device_type", device_type),
    ):
        if value is not None:
            df = df.where(F.col(column) == value)
    if message:
        df = with_templates(df, matching_templates(templates, message, index))
    if without:
        df = without_templates(df, matching_templates(templates, without, index))
    order = [order_by] if order_by == "datetime_sent" else [order_by, "datetime_sent"]
    return readable(df, templates, levels, device_types).orderBy(*order)
