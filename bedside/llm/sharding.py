"""Shards of nearly equal bytes: the smallest feasible capacity over ordered groups, then cuts.

Equal texts are one group and stay together.  Groups are ordered by the hash of their
text, and shards are runs of that order.  A capacity is feasible if taking groups
greedily needs no more shards than there are; the smallest feasible one is found by
binary search.  The cuts then keep within that capacity and as close to equal
shares as it allows.  A group above the mean of what is left has a shard of its own
(the largest first; there are fewer of them than shards), so it does not make the
capacity of all others.

The driver never holds the groups.  It holds a line of segments, one per prefix of
the hash, with the bytes, the largest group and the number of groups of each.  A
segment of several groups gives a lower and an upper place for a cut inside; where
the two answers of a step differ, the segments between them are divided by two more
digits of the hash, and nothing else is.  The result is exactly that over all
groups.  A row's shard follows from its hash and at most as many literals as there
are shards, so no join and no hot group; places inside a shard are counted in parts.

Defined cases: null text is empty and has a size of 8; a row without id and a
repeated row are rows like others, in the shard of their text; with fewer groups
than shards some shards are empty; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .store import column, settle

#: Hexadecimal digits of the hash, those of the first segments, and those by which a segment is divided.
DIGITS, FIRST, MORE = 32, 4, 2
#: Bytes that every row takes besides its text.
OVERHEAD = 8
#: Rows of a shard are numbered in this many parts.
PARTS = 1024


def key_of(text: Column) -> Column:
    """The group of a text: the first 128 bits of its SHA-256; texts that shared them would only share a shard."""
    return F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, DIGITS)


def size_of(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + OVERHEAD).cast("long")


@dataclass
class Line:
    """Segments of the ordered groups: first digits, bytes, largest group and number of groups of each."""

    prefix: np.ndarray
    size: np.ndarray
    largest: np.ndarray
    groups: np.ndarray

    def __post_init__(self):
        order = np.argsort(self.prefix)
        self.prefix, self.size, self.largest, self.groups = (a[order] for a in (self.prefix, self.size, self.largest, self.groups))
        self.edges = np.concatenate([[0], np.cumsum(self.size, dtype=np.int64)])
        self.whole = self.groups == 1
        self.total = int(self.edges[-1])

    def back(self, at: int, hopeful: bool = False) -> int:
        """The last group end at or before ``at``; inside a segment of several groups its start or, hopefully, ``at``."""
        i = int(np.searchsorted(self.edges, at, "right")) - 1
        return at if hopeful and i < len(self.size) and not self.whole[i] else int(self.edges[i])

    def ahead(self, at: int, hopeful: bool = False) -> int:
        """The first group end at or after ``at``, likewise."""
        i = int(np.searchsorted(self.edges, at, "left"))
        return at if hopeful and i and not self.whole[i - 1] else int(self.edges[i])

    def open(self, low: int, high: int) -> set[int]:
        """Segments of several groups that reach into (low, high)."""
        first, last = int(np.searchsorted(self.edges, low, "right")) - 1, int(np.searchsorted(self.edges, high, "left"))
        return {i for i in range(max(first, 0), min(last, len(self.size))) if not self.whole[i]}

    def ends(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        """Where greedily filled shards end; the last one is short of the total if the capacity is too small."""
        out, at = [], 0
        for _ in range(shards):
            at = min(self.back(min(at + capacity, self.total), hopeful), self.total)
            out.append(at)
        return out

    def capacity(self, shards: int, low: int, high: int) -> tuple[int, int, set[int]]:
        """Narrow (infeasible, feasible) as far as the segments tell; what to divide to get on."""
        while high - low > 1:
            middle = (low + high) // 2
            if self.ends(middle, shards, False)[-1] == self.total:
                high = middle
            elif self.ends(middle, shards, True)[-1] < self.total:
                low = middle
            else:
                doubt: set[int] = set()
                at = 0
                for a, b in zip(self.ends(low + 1, shards, False), self.ends(high, shards, True)):
                    doubt |= self.open(a, b + 1)
                    if a == at:  # a segment above the capacity: what comes behind is not known yet
                        break
                    at = a
                return low, high, doubt
        return low, high, set()

    def cuts(self, shards: int, capacity: int) -> tuple[list[int], set[int]]:
        """Ends of all shards but the last, near equal shares of what is left; what to divide before they are certain.

        A cut is as far back as the shards behind it allow at most, and as far on as the capacity does.
        """
        doubt: set[int] = set()
        late = [(self.total, self.total)]  # the earliest ends from which the rest still fits, as (low, high)
        for _ in range(shards - 1):
            low, high = (max(0, x - capacity) for x in late[-1])
            late.append((self.ahead(low, True), self.ahead(high)))
            doubt |= self.open(low, late[-1][1])
        out, low, high = [], 0, 0
        for k in range(1, shards):
            left = shards - k + 1
            limits = []
            for at, earliest in ((low, late[shards - k][0]), (high, late[shards - k][1])):
                share = at + -(-(self.total - at) // left)
                limits.append(min(at + capacity, max(earliest, share), self.total))
            low, high = self.back(limits[0]), self.back(limits[1], True)
            doubt |= self.open(low, limits[1] + (low != limits[0]))
            out.append(low)
        return out, doubt

    def cut_keys(self, ends: list[int]) -> list[str]:
        """The first digits from which on a group is behind each cut; cuts at the end are left out."""
        return [str(self.prefix[int(np.searchsorted(self.edges, at, "left"))]) for at in ends if at < self.total]


@dataclass
class Plan:
    """Groups with a shard of their own, and the keys at which the other shards begin."""

    alone: list[str]
    begins: list[str]
    capacity: int

    def shard(self, key: Column) -> Column:
        found = F.lit(len(self.alone))
        for begin in self.begins:
            found = found + (key >= F.lit(begin)).cast("int")
        for i, own in enumerate(self.alone):
            found = F.when(key == F.lit(own), F.lit(i)).otherwise(found)
        return found.cast("int")


def _line(parts: DataFrame) -> Line:
    """``parts``: prefix, size, largest, groups; a row per segment."""
    found = parts.select("prefix", "size", "largest", "groups").toArrow()
    columns = [np.array(found.column(0).to_pylist(), object), *[found.column(i).to_numpy().astype(np.int64) for i in (1, 2, 3)]]
    return Line(*columns)


def _segments(groups: DataFrame, digits: int) -> DataFrame:
    parts = groups.groupBy(F.substring("key", 1, digits).alias("prefix"))
    return parts.agg(F.sum("size").alias("size"), F.max("size").alias("largest"), F.count(F.lit(1)).alias("groups"))


def _divided(line: Line, groups: DataFrame, which: set[int]) -> Line:
    """``line`` with some segments divided by more digits."""
    chosen = sorted(which)
    new = []
    for digits in sorted({len(line.prefix[i]) for i in chosen}):
        wanted = pa.table({"prefix": [line.prefix[i] for i in chosen if len(line.prefix[i]) == digits]})
        wanted = groups.sparkSession.createDataFrame(wanted)  # a few hundred rows, known to the planner
        mine = groups.withColumn("prefix", F.substring("key", 1, digits)).join(wanted, "prefix", "left_semi")
        new.append(_line(_segments(mine, min(DIGITS, digits + MORE))))
    kept = np.ones(len(line.size), bool)
    kept[chosen] = False
    fields = ("prefix", "size", "largest", "groups")
    return Line(*[np.concatenate([getattr(line, f)[kept], *[getattr(x, f) for x in new]]) for f in fields])


def planned(groups: DataFrame, shards: int) -> Plan:
    """The plan for a table of groups: key, size (bytes of all its rows)."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    alone, left = [], total
    for key, size in groups.orderBy(F.col("size").desc(), "key").limit(shards).collect():
        if len(alone) + 1 >= shards or size * (shards - len(alone)) <= left:
            break
        alone.append(key)
        left -= size
    shards -= len(alone)
    rest = groups.filter(~F.col("key").isin(alone)) if alone else groups
    if not left:
        return Plan(alone, [], 0)
    line = _line(_segments(rest, FIRST))
    mean, largest = -(-left // shards), int(line.largest.max())
    low, high = max(mean, largest) - 1, mean + largest
    while True:
        low, high, doubt = line.capacity(shards, low, high)
        if not doubt:
            ends, doubt = line.cuts(shards, high)
            if not doubt or high - low > 1:
                return Plan(alone, line.cut_keys(ends), high)
        line = _divided(line, rest, doubt)


def sharded(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: this law has none)."""
    text = column(text_col).cast("string")
    rows = docs.select(
        column(id_col).alias("doc_id"),
        size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        key_of(text).alias("key"),
        F.monotonically_increasing_id().alias("row_number"),
    )
    rows = settle(rows, "shard-rows")
    plan = planned(settle(rows.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups"), shards)
    part = F.pmod(F.xxhash64("row_number"), F.lit(PARTS)).cast("int")
    placed = rows.withColumn("shard", plan.shard(F.col("key"))).withColumn("part", part)
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")  # shards times parts
    rank = F.row_number().over(W.partitionBy("shard", "part").orderBy("row_number"))
    return (
        placed.withColumn("rank", rank)
        .join(starts, ["shard", "part"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def with_shard(docs: DataFrame, shards: int = 24, text_col: str = "text") -> tuple[DataFrame, str]:
    """All rows and columns of ``docs`` and their shard, and the name of that column: ``shard``, or longer if it is taken."""
    text = column(text_col).cast("string")
    sizes = docs.select(key_of(text).alias("key"), size_of(text).alias("size"))
    plan = planned(settle(sizes.groupBy("key").agg(F.sum("size").alias("size")), "shard-groups"), shards)
    name = "shard"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return docs.withColumn(name, plan.shard(key_of(text))), name


def write_shards(docs: DataFrame, path: str, shards: int = 24, text_col: str = "text") -> str:
    """Write ``docs`` as Parquet, a folder per shard; texts are not shuffled. Gives the name of the shard column."""
    rows, name = with_shard(docs, shards, text_col)
    rows.write.partitionBy(name).parquet(path)
    return name
