"""Packet selection, decoded packets to typed rows, chunk manifest."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clock
from ..operators import slices
from ..operators.slices import balance, following, previous, running_sum, scan, unsliced
from ..session import durable


def selected(packets: DataFrame, session: int, start_ms: int, stop_ms: int, types: list[int]) -> DataFrame:
    """Packets of a session by time range and type, in time order."""
    return packets.where(
        (F.col("session") == session) & F.col("tm").between(start_ms, stop_ms) & F.col("id").isin(*types)
    ).orderBy("tm", "sn")


def selected_logs(packets: DataFrame, device: int, start_ms: int, stop_ms: int, margin_s: int = 60) -> DataFrame:
    margin = margin_s * 1000
    return packets.where(
        (F.col("device") == device) & F.col("tm").between(start_ms - margin, stop_ms + margin)
    ).orderBy("tm", "sn")


def repaired(packets: DataFrame) -> DataFrame:
    return packets.withColumn("tm", clock.repaired_ms(F.col("tm"), F.col("doc_tm"))).withColumn(
        "segment", F.coalesce("segment", F.lit(0))
    )


def active_alarms(packets: DataFrame, placeholder: int = 999) -> tuple[DataFrame, DataFrame]:
    """Alarm packets to one row per active alarm and their status rows.

    A packet without alarms keeps one placeholder row.  ``alarms`` is an array
    of (code, severity, state, start_sn).
    """
    rows = packets.select("session", "sn", "t", F.explode_outer("alarms").alias("a")).select(
        "session",
        "sn",
        "t",
        F.coalesce("a.code", F.lit(placeholder)).alias("code"),
        "a.severity",
        "a.state",
        "a.start_sn",
    )
    status = packets.select("session", "sn", "t", F.size("alarms").alias("active"), "status")
    return rows, status


def typed_readings(numeric: DataFrame, passed: DataFrame, syncs: DataFrame, analytics: DataFrame) -> DataFrame:
    """Decoded packets of every family as one readings frame.

    Families that share a series name are united.  A packet gives one row per
    field, ``field`` counting from 0: ``numeric`` and analytics packets carry
    ``values``, pass-through packets skip their first one.  Sync packets carry
    milliseconds; analytics rows carry their own time.
    """

    def fields(packets: DataFrame, param, t, first: int = 0) -> DataFrame:
        rest = F.slice("values", first + 1, F.greatest(F.size("values") - first, F.lit(0)))
        return packets.select("session", param, "sn", t.alias("t"), F.posexplode(rest).alias("field", "value")).withColumn(
            "value", F.col("value").cast("double")
        )

    untimed, timed = F.lit(None).cast("double"), F.col("tm_ms") / 1000.0
    out = fields(numeric, F.col("param"), untimed)
    skip = fields(passed, F.col("param"), untimed, 1)
    sync = syncs.select(
        "session",
        F.lit("TIME_SYNC").alias("param"),
        "sn",
        timed.alias("t"),
        F.lit(0).alias("field"),
        F.col("device").cast("double").alias("value"),
    )
    extra = fields(analytics, F.concat(F.lit("ANALYTICS_"), F.col("subtype")).alias("param"), timed)
    for part in (skip, sync, extra):
        out = out.unionByName(part)
    return out


def device_sessions(raw: DataFrame, id_offset: int = 0) -> DataFrame:
    """Tidy session records: offset taken off, times as epoch milliseconds."""
    return raw.select(
        (F.col("group_id") - id_offset).alias("group_id"),
        "device_id",
        clock.epoch_ms(F.col("start_time")).alias("t0"),
        clock.epoch_ms(F.col("stop_time")).alias("t1"),
    )


def logs_into_session(packets: DataFrame, device: int, t0: int, t1: int, syncs: DataFrame) -> DataFrame:
    """Log packets of a device that lie inside a sync segment, with its sequence numbers.

    ``syncs``: (segment, sn, tm) anchors.  The first segment that holds the
    time gives its number, interpolated between anchors and truncated.
    """
    rows = packets.where((F.col("device") == device) & F.col("tm").between(t0, t1)).select(
        "id", "sn", "tm", "device", "raw"
    )
    rows = rows.dropDuplicates()
    anchors = scan(
        balance(syncs, ["segment"], "sn"),
        ["segment"],
        ["sn"],
        sn1=following("sn"),
        tm1=following("tm"),
    )
    spans = unsliced(anchors).where("sn1 is not null and tm1 > tm").select(
        "segment", F.col("sn").alias("sn0"), F.col("tm").alias("tm0"), "sn1", "tm1"
    )
    from ..operators.ranges import point_join

    rows = rows.withColumn("_one", F.lit(1))
    spans = spans.withColumn("_one", F.lit(1))
    pairs = point_join(
        rows, spans, ["_one"], F.col("tm"), (F.col("tm0"), F.col("tm1") - 1), 3_600_000.0
    )
    sn = F.col("b.sn0") + (F.col("a.tm") - F.col("b.tm0")) * (F.col("b.sn1") - F.col("b.sn0")) / (
        F.col("b.tm1") - F.col("b.tm0")
    )
    return pairs.groupBy(
        F.col("a.id").alias("id"), F.col("a.tm").alias("tm"), F.col("a.device").alias("device"),
        F.col("a.raw").alias("raw"), F.col("a.sn").alias("own_sn"),
    ).agg(F.min(F.struct(F.col("b.segment").alias("segment"), sn.cast("bigint").alias("sn"))).alias("_p")).select(
        "id", "_p.sn", "tm", "device", "_p.segment", "raw"
    )


CHUNK_BYTES = 512_000
FAN = 8  # slices a node of the hand-over tree takes


def _cuts(sizes: np.ndarray, carried: int, limit: int) -> tuple[np.ndarray, int, int]:
    """Chunk number of each packet from ``carried`` bytes on, bytes left open, chunks closed.

    A chunk closes with the packet that brings it to the limit.
    """
    ends = np.cumsum(sizes)
    number = np.zeros(len(sizes), dtype=np.int64)
    base, at, chunk = -carried, 0, 0
    while at < len(sizes):
        close = int(np.searchsorted(ends, base + limit, side="left"))
        number[at : close + 1] = chunk
        if close >= len(sizes):
            break
        base, at, chunk = int(ends[close]), close + 1, chunk + 1
    return number, int(ends[-1] - base) if len(sizes) else carried, chunk


def chunk_manifest(
    packets: DataFrame, keys=("session",), order=("seq",), limit: int = CHUNK_BYTES, slice_rows: int = 1_000_000
) -> DataFrame:
    """Chunks of each packet stream: number, bytes, segment, time and sn range.

    A chunk is cut where the segment changes and with the packet that brings it
    to ``limit`` bytes.  A stretch of one segment is cut into slices of at most
    ``slice_rows`` packets.  How far a slice is filled when it starts depends on
    the slice before, so every slice first works out, for each amount it may
    inherit, what it leaves (packets and bytes decide, not their content).  These
    step functions are composed in a tree of ``FAN`` slices a node, and what each
    slice inherits is handed down the same tree, so no task sees more than ``FAN``
    of them however long the stretch.
    """
    known = F.when(F.col("sn").isNotNull(), F.col("segment"))
    checked = balance(packets, keys, order[0])
    filled = scan(
        checked,
        keys,
        order,
        _seg=slices.filled(known),
        _first=slices.refilled(known),
    )
    filled = filled.withColumn("_seg", F.coalesce("_seg", "_first", F.lit(-1))).drop("_first")
    marked = scan(filled, keys, order, _was=previous("_seg"))
    cut = F.when(F.col("_seg") != F.coalesce("_was", "_seg"), 1).otherwise(0)
    marked = scan(marked.withColumn("_cut", cut), keys, order, _stretch=running_sum("_cut"))
    marked = scan(
        marked, [*keys, "_stretch"], order, _n=running_sum(F.lit(1)), _end=running_sum("size")
    )
    part = F.floor((F.col("_n") - 1) / slice_rows)
    rows = unsliced(marked).withColumn("_part", part).select(
        *keys, "_stretch", "_seg", "_part", "_n", "size", "sn", "tm"
    )
    rows = durable(rows)  # read three times below
    group = [*keys, "_stretch"]
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    head = ", ".join(f"{c} {types[c]}" for c in group)

    # what a slice leaves, as a step function of what it inherits
    def leaves(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_n")
        ends = np.cumsum(pdf["size"].to_numpy(dtype=np.int64))
        inherit, left, closed = _transfer(ends, limit)
        out = pdf.iloc[:1][[*group, "_part"]].copy()
        out["inherit"], out["left"], out["closed"] = [inherit], [left], [closed]
        return out

    schema = f"{head}, _part bigint, inherit array<bigint>, left array<bigint>, closed array<bigint>"
    carries = f"{head}, _part bigint, _carried bigint, _base bigint"
    last_part = rows.agg(F.max("_part")).first()[0] or 0
    if last_part:
        multi = rows.groupBy(*group).agg(F.max("_part").alias("_parts")).where("_parts > 0").drop("_parts")
        steps = (
            rows.join(multi, group, "left_semi")
            .select(*group, "_part", "_n", "size")
            .groupBy(*group, "_part")
            .applyInPandas(leaves, schema)
        )
        starts = _inherited(durable(steps), group, schema, carries, last_part)
        ready = rows.join(starts, [*group, "_part"], "left").fillna(0, ["_carried", "_base"])
    else:
        ready = rows.withColumn("_carried", F.lit(0).cast("bigint")).withColumn("_base", F.lit(0).cast("bigint"))

    kept = [*group, "_part", "_n", "size", "sn", "tm", "_seg", "_carried", "_base"]
    part_schema = (
        f"{head}, _no bigint, _seg {types['_seg']}, size bigint, "
        "min_ts bigint, max_ts bigint, min_sn bigint, max_sn bigint"
    )

    def pieces(batches):
        """Sorted packets to chunk pieces; the open chunk is carried over batches."""
        last, carried, number = None, 0, 0
        for pdf in batches:
            if not len(pdf):
                continue
            same = np.ones(len(pdf), dtype=bool)
            for c in [*group, "_part"]:
                v = pdf[c].to_numpy()
                same[1:] &= v[1:] == v[:-1]
            same[0] = False
            heads = np.flatnonzero(~same)
            sizes = pdf["size"].to_numpy(dtype=np.int64)
            no = np.empty(len(pdf), dtype=np.int64)
            for lo, hi in zip(heads, np.r_[heads[1:], len(pdf)]):
                key = tuple(pdf[c].iat[lo] for c in [*group, "_part"])
                if key != last:
                    last, carried, number = key, int(pdf["_carried"].iat[lo]), int(pdf["_base"].iat[lo])
                cuts, carried, closed = _cuts(sizes[lo:hi], carried, limit)
                no[lo:hi] = cuts + number
                number += closed
            first = np.flatnonzero(np.r_[True, (np.diff(no) != 0) | ~same[1:]])
            out = pdf.iloc[first][group].copy()
            out["_no"] = no[first]
            out["_seg"] = pdf["_seg"].to_numpy()[first]
            out["size"] = np.add.reduceat(sizes, first)
            for column, low, high in (("tm", "min_ts", "max_ts"), ("sn", "min_sn", "max_sn")):
                values = pdf[column].to_numpy(dtype=float, na_value=np.nan)
                out[low] = pd.array(np.fmin.reduceat(values, first)).astype("Int64")
                out[high] = pd.array(np.fmax.reduceat(values, first)).astype("Int64")
            yield out

    parts = (
        ready.select(*kept)
        .repartition(*group, "_part")
        .sortWithinPartitions(*group, "_part", "_n")
        .mapInPandas(pieces, part_schema)
    )
    chunks = parts.groupBy(*group, "_no", "_seg").agg(
        F.sum("size").alias("size"),
        F.min("min_ts").alias("min_ts"),
        F.max("max_ts").alias("max_ts"),
        F.min("min_sn").alias("min_sn"),
        F.max("max_sn").alias("max_sn"),
    )
    chunks = chunks.where("size > 0")
    # a stretch that ends with a full chunk leaves an empty one, which uses up a number
    chunks = scan(
        balance(chunks, keys, "_stretch", reduced=checked),
        keys,
        ["_stretch", "_no"],
        _p=previous(F.struct("_stretch", "size")),
    )
    empty = (F.col("_p._stretch") != F.col("_stretch")) & (F.col("_p.size") >= limit)
    step = F.when(F.coalesce(empty, F.lit(False)), 2).otherwise(1).cast("bigint")
    chunks = scan(chunks.withColumn("_step", step), keys, ["_stretch", "_no"], num=running_sum("_step"))
    return unsliced(chunks).select(
        *keys, (F.col("num") - 1).alias("num"), "size", F.col("_seg").alias("segment"),
        "min_ts", "max_ts", "min_sn", "max_sn",
    )


def _inherited(steps: DataFrame, group: list, schema: str, carries: str, last_part: int) -> DataFrame:
    """Bytes and chunk number each slice starts with, from the step functions of all.

    Up the tree the functions of ``FAN`` neighbours are composed into one; down
    the tree each node hands its start on through its children.
    """
    up = F.expr(f"_part div {FAN}")

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_part")
        whole = None
        for step in zip(pdf["inherit"], pdf["left"], pdf["closed"]):
            step = tuple(np.asarray(a, dtype=np.int64) for a in step)
            whole = step if whole is None else _composed(whole, step)
        out = pdf.iloc[:1][group].copy()
        out["_part"] = pdf["_part"].iat[0] // FAN
        out["inherit"], out["left"], out["closed"] = ([a] for a in whole)
        return out

    def hand_down(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_part")
        carried, number = int(pdf["_carried"].iat[0]), int(pdf["_base"].iat[0])
        starts = []
        for inherit, left, closed in zip(pdf["inherit"], pdf["left"], pdf["closed"]):
            starts.append((carried, number))
            i = int(np.searchsorted(np.asarray(inherit), carried, side="right")) - 1
            # a slice that closes nothing adds its bytes to what it inherits
            carried = int(left[i]) + (carried if closed[i] == 0 else 0)
            number += int(closed[i])
        out = pdf[[*group, "_part"]].copy()
        out["_carried"], out["_base"] = zip(*starts)
        return out

    levels = [steps]
    while last_part >= FAN:
        above = levels[-1].groupBy(*group, up.alias("_up")).applyInPandas(compose, schema)
        levels.append(durable(above))
        last_part //= FAN
    nothing = F.lit(0).cast("bigint")
    starts = None
    for nodes in reversed(levels):
        nodes = nodes.withColumn("_up", up)
        if starts is None:
            nodes = nodes.withColumn("_carried", nothing).withColumn("_base", nothing)
        else:
            nodes = nodes.join(starts.withColumnRenamed("_part", "_up"), [*group, "_up"])
        starts = nodes.groupBy(*group, "_up").applyInPandas(hand_down, carries)
    return starts


def _composed(first, second):
    """One step function for two neighbouring slices.

    Each is (inherit, left, closed) arrays by rising inherited amount.  Only the
    first step can close nothing; there the bytes are added to what is inherited,
    everywhere else what is left does not depend on it.
    """
    inherit, left, closed = first
    inherit2, left2, closed2 = second

    def then(left, closed):
        at = np.searchsorted(inherit2, left, side="right") - 1
        return left2[at] + np.where(closed2[at] == 0, left, 0), closed + closed2[at]

    out_left, out_closed = then(left, closed)
    if closed[0] == 0:
        # the amounts of this step reach the second slice one by one: its steps show through
        base = left[0]
        seen = inherit2 > base
        if len(inherit) > 1:
            seen &= inherit2 < inherit[1] + base
        inherit = np.r_[0, inherit2[seen] - base, inherit[1:]]
        out_left = np.r_[out_left[0], left2[seen], out_left[1:]]
        out_closed = np.r_[out_closed[0], closed2[seen], out_closed[1:]]
    new = np.r_[True, (np.diff(out_left) != 0) | (np.diff(out_closed) != 0)]
    return inherit[new], out_left[new], out_closed[new]


def _transfer(ends: np.ndarray, limit: int):
    """For every inherited amount in [0, limit): bytes left open and chunks closed.

    The first packet that closes a chunk falls as the inherited amount grows,
    so the answer is a step function: one entry per first closing packet.  From
    a closing packet on, the cuts no longer depend on the amount: its chain of
    closing packets is followed by doubling jumps, all packets at once.
    """
    n = len(ends)
    jump = np.searchsorted(ends, ends + limit, side="left")  # next closing packet after one that closed
    last = np.arange(n)
    closed = np.ones(n, dtype=np.int64)
    while len(open_ := np.flatnonzero(jump < n)):
        to = jump[open_]
        closed[open_] += closed[to]
        last[open_] = last[to]
        jump[open_] = jump[to]
    left = ends[-1] - ends[last]
    reach = int(np.searchsorted(ends, limit, side="left"))  # first close when nothing is inherited
    if reach >= n:
        start, out_left, out_closed, before = 0, int(ends[-1]), 0, n
    else:
        start, out_left, out_closed, before = 0, int(left[reach]), int(closed[reach]), reach
    # smallest amount with which each packet closes; of packets without bytes the first one
    need = limit - ends[:before]
    keep = (need < limit) & np.r_[True, np.diff(ends[:before]) > 0][:before]
    rows = np.flatnonzero(keep)[::-1]
    return (
        np.r_[start, need[rows]],
        np.r_[out_left, left[rows]],
        np.r_[out_closed, closed[rows]],
    )
