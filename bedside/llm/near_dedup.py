"""Near duplicates: fast similarity sketching, banding, exact verification, components.

A text's set is that of its word shingles.  Its sketch has one coordinate per bin:
in each round every element is hashed to a bin and a value, and a bin that is
still empty takes the smallest value it was sent.  After as many rounds as bins
each round serves one bin directly, so every coordinate is filled; most texts are
done after a few rounds.  Coordinates of two sketches agree with a probability
equal to the Jaccard similarity, with concentration as for independent hashes.

Rows of equal word sequences are one class; only its smallest id goes on.
Sketches are cut into bands, and classes that agree in a whole band are
candidates.  A bucket is not expanded into all pairs: its first member is compared
with the others, true links are merged into components, and only buckets whose
members are still in different components are looked at again, now with their
first eight members as leaders.  In buckets that are open even then, members
outside the bucket's largest component are compared with all that are not in their
own.  Two members that never met are in one component, so no link is lost.  For the
later looks the texts left get a longer sketch of which one bit per coordinate is
kept; pairs whose bits differ too much never leave the join.  Links are confirmed
on the full shingle sets.

At a similarity of 0.8 two texts share none of the 44 bands of 6 coordinates with
a probability of 1.6e-6, at 0.85 of 1e-9; the bits of such a pair differ too much
(five standard deviations) with a probability of 3e-7.

Defined cases: null text and text without words have no shingles and are linked
with nothing; a text of fewer words than a shingle is one shingle; a row without
id stays alone; rows that share an id are one document, linked by any of its texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .components import components
from .store import column, hold, portions, settle, small_batches, spread, whole_row

BANDS, ROWS = 44, 6
#: Bytes of text and rows that are sketched at once.
PORTION, TOGETHER = 1 << 20, 1000
REMEMBERED, LONGEST = 120_000, 40
#: Members of an open bucket that all others are compared with at the second look.
LEADERS = 8
#: Members of a bucket that meet in one cell of a later look, on either side.
CELL = 256
#: Coordinates of the longer sketch, of each one bit, and the standard deviations that are allowed for.
BITS, SIGMAS = 4096, 5.0
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _round_seed(i: int) -> np.uint64:
    return np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


def sketches(elements: np.ndarray, owner: np.ndarray, sets: int, bins: int) -> np.ndarray:
    """Similarity sketches of ``sets`` sets; ``owner`` tells the set of each element. No set is empty."""
    out, filled = np.full(sets * bins, _FULL), np.zeros(sets, np.int64)
    for i in range(2 * bins):
        hashed = _mix(elements ^ _round_seed(i))
        if i < bins:
            place = owner * bins + ((hashed >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        else:
            place = owner * bins + (i - bins)
        empty = out[place] == _FULL  # at the start of the round: it decides by the smallest value
        place = place[empty]
        np.minimum.at(out, place, _mix(hashed[empty] ^ np.uint64(0xD1B54A32D192ED03)))
        filled += np.bincount(np.unique(place) // bins, minlength=sets)
        left = filled[owner] < bins
        if not left.all():
            elements, owner = elements[left], owner[left]
            if not len(elements):
                break
    return out.reshape(sets, bins)


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    """One number per band of a sketch, different bands apart."""
    cut = sketch.reshape(len(sketch), bands, -1)
    key = np.tile(np.arange(bands, dtype=np.uint64), (len(sketch), 1))
    for r in range(cut.shape[2]):
        key = _mix(key ^ cut[:, :, r]) + np.uint64(0x9E3779B97F4A7C15)
    return key.view(np.int64)


class _Words(dict):
    """64-bit hash of each word, for as many as fit."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONGEST:
            if len(self) > REMEMBERED:
                self.clear()
            self[word] = found
        return found


_WORDS = _Words()


def words_of(text: str | None) -> list[bytes]:
    """Words, A-Z in lower case; bytes split at ASCII white space only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _key(words: list[bytes]) -> bytes:
    return sha256(b" ".join(words)).digest()


def _elements(words: list[bytes], size: int) -> np.ndarray:
    hold("near", _WORDS.clear)
    hashed = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, np.uint64(len(words) if len(words) < size else 0))
    for i in range(width):
        out = _mix(out ^ hashed[i : len(hashed) - width + 1 + i]) + np.uint64(i + 1)
    return np.unique(out)


def _shingles(words: list[bytes], size: int) -> set:
    return set(zip(*(words[i:] for i in range(size)))) if len(words) >= size else {tuple(words)}


def sketched(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: doc_id, n_shingles, key (of the word sequence), bands; the last two null without words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in portions(batches, "text", PORTION):
            for at in range(0, portion.num_rows, TOGETHER):
                batch = portion.slice(at, TOGETHER)
                split = [words_of(t) for t in batch.column(1).to_pylist()]
                keys = [_key(w) if w else None for w in split]
                first = {k: i for i, k in reversed(list(enumerate(keys))) if k}  # copies in a portion are sketched once
                sets = {k: _elements(split[i], shingle) for k, i in first.items()}
                bands = {}
                if sets:
                    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets.values()])
                    found = sketches(np.concatenate(list(sets.values())), owner, len(sets), BANDS * ROWS)
                    bands = dict(zip(sets, band_keys(found, BANDS)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([len(sets[k]) if k else 0 for k in keys], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array([bands[k] if k else None for k in keys], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "key", "bands"],
                )

    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))
    return rows.mapInArrow(sketch, "doc_id long, n_shingles long, key binary, bands array<long>")


def bit_sketches(texts: DataFrame, shingle: int) -> DataFrame:
    """For rows of id and text: id, key (of the word sequence), bits (one per coordinate of a longer sketch, in 64-bit words)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in portions(batches, "text", PORTION):
            for at in range(0, portion.num_rows, TOGETHER // 4):
                batch = portion.slice(at, TOGETHER // 4)
                split = [words_of(t) for t in batch.column(1).to_pylist()]
                sets = [_elements(w, shingle) for w in split]
                owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
                found = sketches(np.concatenate(sets), owner, len(sets), BITS)
                words = np.packbits((found >> np.uint64(17) & np.uint64(1)).astype(bool), axis=1).view("<i8")
                keys = pa.array([_key(w) for w in split], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), keys, pa.array(list(words), pa.list_(pa.int64()))], ["id", "key", "bits"])

    return texts.select("id", "text").mapInArrow(sketch, "id long, key binary, bits array<long>")


def _alike(a: Column, b: Column, percent: int) -> Column:
    """Whether two texts may reach the similarity, as far as their bits tell; a quarter of them is looked at first."""
    differ = (1 - percent / 100) / 2

    def near(bits: int) -> Column:
        limit = math.floor(bits * differ + SIGMAS * math.sqrt(bits * differ * (1 - differ)))
        return reduce(add, (F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(bits // 64))) <= limit

    return near(BITS // 4) & near(BITS)


def _first_met(band: Column, a: Column, b: Column) -> Column:
    """Whether ``band`` is the first that two texts share, so that a pair comes out of one bucket only."""
    shared = F.zip_with(a, b, lambda x, y: F.when(x == y, x))
    return F.get(F.filter(shared, lambda x: x.isNotNull()), F.lit(0)) == band


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, set] = {}
        for batch in batches:
            a, b, text_a, text_b = (c.to_pylist() for c in batch.columns)
            kept = []
            for i in range(len(a)):
                one = _shingles(words_of(text_a[i]), shingle)
                if b[i] not in known:  # pairs come sorted by b: its set serves many
                    known = {b[i]: _shingles(words_of(text_b[i]), shingle)}
                both = len(one & known[b[i]])
                if 100 * both >= percent * (len(one) + len(known[b[i]]) - both):
                    kept.append(i)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(kept, pa.int64())) for c in batch.columns[:2]], ["a", "b"])

    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    other = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(confirm, "a long, b long")


def _dealt(live: DataFrame, some: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides of a look dealt over the cells of each bucket: every two members meet in exactly one cell.

    A bucket of n members, m of which are compared with all, is a grid of n / CELL by m / CELL cells.
    """
    counts = live.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.join(some.groupBy("band").agg(F.count(F.lit(1)).alias("m")), "band")
    grid = settle(counts.select("band", *[F.ceil(F.col(c) / CELL).cast("int").alias(c) for c in ("n", "m")]), "grid")
    row, column_ = (F.pmod(F.xxhash64("id", F.lit(seed)), F.col(c)).cast("int") for seed, c in ((21, "n"), (22, "m")))
    across = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda k: row * F.col("m") + k)
    down = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda k: k * F.col("m") + column_)
    return (
        live.join(grid, "band").select("band", "id", "low", F.explode(across).alias("cell")),
        some.join(grid, "band").select("band", "id", "low", F.explode(down).alias("cell")),
    )


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    small_batches(docs.sparkSession)
    rows = settle(sketched(docs, shingle, id_col, text_col), "sketches")
    having = rows.filter("key is not null and doc_id is not null")
    classes = settle(having.groupBy("key").agg(F.min("doc_id").alias("id")), "classes")
    first = having.withColumnRenamed("doc_id", "id").join(classes, ["key", "id"], "left_semi")
    banded = first.select("id", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("id").alias("leader"), F.max("id").alias("top")).filter("leader < top")
    live = settle(banded.join(buckets.select("band", "leader"), "band"), "buckets")

    members = live.select("id")
    texts = settle(
        docs.select(column(id_col).cast("long").alias("id"), column(text_col).cast("string").alias("text")).join(members, "id", "left_semi"),
        "candidates",
    )
    pairs = settle(live.filter("id <> leader").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct(), "pairs")
    # the texts of one id hang together
    text = F.xxhash64("key")
    several = having.groupBy("doc_id").agg(F.min(text).alias("one"), F.max(text).alias("other")).filter("one < other").select("doc_id")
    several = settle(several, "several")
    own = having.join(several, "doc_id").join(classes, "key").filter("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    linked = components(settle(confirmed(pairs, texts, shingle, percent).unionByName(own), "confirmed"))
    tested, bits = pairs, None
    for look in ("leaders", "rest"):
        labelled = live.select("band", "id").join(linked.withColumnRenamed("node", "id"), "id", "left").select(
            "band", "id", F.coalesce("low", "id").alias("low")
        )
        # of two members one is the first, with which the other has been compared
        still = labelled.groupBy("band").agg(F.min("low").alias("from"), F.max("low").alias("to"), F.count(F.lit(1)).alias("n"))
        live = settle(labelled.join(still.filter((F.col("from") < F.col("to")) & (F.col("n") > 2)), "band", "left_semi"), "buckets")
        if live.isEmpty():
            break
        if bits is None:
            bits = bit_sketches(texts.join(live.select("id"), "id", "left_semi"), shingle)
            # an id may have several texts, each with its own bands and bits
            bits = settle(bits.join(first.select("id", "key", "bands"), ["id", "key"]).drop("key").distinct(), "bits")
        if look == "leaders":
            rank = F.row_number().over(W.partitionBy("band").orderBy("id"))
            some = live.withColumn("rank", rank).filter(F.col("rank") <= LEADERS)
        else:
            sizes = live.groupBy("band", "low").agg(F.count(F.lit(1)).alias("n"))
            largest = sizes.groupBy("band").agg(F.max(F.struct("n", "low")).getField("low").alias("largest"))
            some = live.join(largest, "band").filter(F.col("low") != F.col("largest"))
        one, other = _dealt(live, some)
        other = other.join(bits, "id").select("band", "cell", *[F.col(c).alias(f"other_{c}") for c in ("id", "low", "bits", "bands")])
        near = (F.col("low") != F.col("other_low")) & _alike(F.col("bits"), F.col("other_bits"), percent)
        once = _first_met(F.col("l.band"), F.col("bands"), F.col("other_bands"))
        pairs = settle(
            one.join(bits, "id")
            .alias("l")
            .join(other.alias("o"), (F.col("l.band") == F.col("o.band")) & (F.col("l.cell") == F.col("o.cell")) & near & once)
            .select(F.greatest("id", "other_id").alias("a"), F.least("id", "other_id").alias("b"))
            .distinct()
            .join(tested, ["a", "b"], "left_anti"),
            "pairs",
        )
        tested = tested.unionByName(pairs)
        more = settle(confirmed(pairs, texts, shingle, percent), "confirmed")
        if not more.isEmpty():
            stars = linked.select(F.col("node").alias("a"), F.col("low").alias("b"))
            linked = components(stars.unionByName(more))

    groups = classes.join(linked.withColumnRenamed("node", "id"), "id", "left").select("key", F.coalesce("low", "id").alias("low"))
    lowest = several.join(linked, F.col("doc_id") == F.col("node")).select("doc_id", F.col("low").alias("own"))
    found = rows.select("doc_id", "n_shingles", "key").join(groups, "key", "left").join(lowest, "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("own", "low", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def without_near_copies(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first document of each component, with all its columns."""
    stays = near_duplicates(docs, shingle, percent, id_col, text_col).filter("kept").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), whole_row(docs).alias("row"))
    return spread(rows.join(stays, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi"), "row", docs.columns)
