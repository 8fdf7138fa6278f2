"""Best-fit packing of token pieces into sequences of a fixed capacity.

Pieces of equal length are alike, so the packing is decided on the histogram of
lengths, whose size the capacity bounds.  Its configuration linear program (how
often to use each way to fill a sequence, so that all lengths are covered) is
solved by multiplicative weights: a length's price falls as it gets covered, and
a knapsack dynamic program over the capacity finds the fillings that are worth
most at the current prices.  The fractional solution is rounded as far as the
counts allow, fullest and most used fillings first; what is left is filled
best-fit, longest piece first, again per length and not per piece.

On the cluster each piece only needs its rank among the pieces of its length.
Ranks are counted in parts (a hash of the document id), so that a length that
holds a third of all pieces is no single task's work.

Defined cases: null text is empty; an empty text is one piece that holds just
the end id; repeated rows are packed each on their own.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .merges import PairMerges
from .store import column, hold, portions, settle, small_batches

PARTS = 1024
#: Rounds of multiplicative weights, fillings taken per round, and the step.
ROUNDS, PER_ROUND, STEP, ETA = 48, 192, 0.34, 3.0
#: Words a worker remembers, and the longest it remembers.
REMEMBERED, LONGEST = 400_000, 40
PORTION = 4 << 20
#: Letters that lower-casing and composition treat one by one, then other marks, which are a word of their own.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=>?@\[-`{-~]*)")


class WordIds:
    """Token ids of words as ``tokenizers`` gives them for a vocabulary with word ends.

    White space never reaches a token of such a vocabulary, so a text's ids are
    those of its space-separated words.  Words of plain letters are merged in
    arrays, all new ones of a portion together; any other goes to the library.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # a merge comes after those that make its halves, so all places can be merged at once
        made = [vocabulary[a + b] for a, b in pairs]
        made_at = {m: r for r, m in reversed(list(enumerate(made)))}
        late = [made_at.get(vocabulary[x], -1) >= r for r, p in enumerate(pairs) for x in p]
        self.merges = PairMerges(
            [vocabulary[a] for a, _ in pairs], [vocabulary[b] for _, b in pairs], list(range(len(pairs))), made, [False] * len(pairs)
        )
        self.all_at_once = not any(late)
        sign = _byte_signs()
        self.inner = np.array([vocabulary.get(sign[b], -1) for b in range(256)])
        self.last = np.array([vocabulary.get(sign[b] + end, -1) for b in range(256)])
        self.seen: dict[str, bytes] = {"": b""}

    def _merged(self, words: list[str]) -> list[bytes]:
        raw = [w.lower().encode() for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[flat[ends]]
        ids, owner = self.merges.merge(symbols, np.repeat(np.arange(len(raw)), lengths), len(raw))
        cuts = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(raw)))] * 4
        data = ids.astype("<u4").tobytes()
        return [data[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def new(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are not known yet."""
        plain, other, ids, marked = set(), [], {}, []
        for w in words:
            found = PLAIN.fullmatch(w) if self.all_at_once else None
            if found is None:
                other.append(w)
            elif found[2]:
                marked.append((w, found[1], found[2]))
            else:
                plain.add(w)
        plain.update(stem for _, stem, _ in marked if stem not in self.seen)
        other += {mark for _, _, mark in marked if mark not in self.seen}
        if plain:
            ids = dict(zip(plain, self._merged(list(plain))))
        ids.update(zip(other, self._library(other)))
        for w, stem, mark in marked:
            first, second = ids.get(stem), ids.get(mark)
            ids[w] = (self.seen[stem] if first is None else first) + (self.seen[mark] if second is None else second)
        return ids

    def _library(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch(words, add_special_tokens=False)]

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.seen) > REMEMBERED:
            self.seen = {"": b""}
        split = [_words(t) if t else [] for t in texts]
        now = self.new(list(set(chain.from_iterable(split)).difference(self.seen)))
        long = [w for w in now if len(w) > LONGEST]
        kept = {w: now.pop(w) for w in long}
        self.seen.update(now)
        out = []
        for words in split:
            try:
                out.append(b"".join(map(self.seen.__getitem__, words)))
            except KeyError:
                out.append(b"".join([kept[w] if w in kept else self.seen[w] for w in words]))
        return out


def _words(text: str) -> list[str]:
    if "<|" not in text:  # special tokens are found before lower-casing
        try:
            text.encode("latin-1")  # composed letters, each with one lower case
            text = text.lower()
        except UnicodeEncodeError:
            pass
    return text.replace("\n", " ").split(" ")


def _byte_signs() -> list[str]:
    """The printable sign of each byte in byte-level vocabularies: itself, or the next free code point from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


_IDS: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    """The vocabulary and the words seen stay with the worker."""
    hold("packing", _IDS.clear)
    if path not in _IDS:
        _IDS[path] = WordIds(path)
    return _IDS[path]


def token_pieces(
    docs: DataFrame, path: str, end_id: int, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids (little-endian unsigned 32-bit)."""
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _word_ids(path)
        for batch in portions(batches, "text", PORTION):
            rows, pieces, starts, parts = [], [], [], []
            for i, ids in enumerate(ids_of.texts(batch.column(1).to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    rows.append(i)
                    pieces.append(k)
                    starts.append(at // 4)
                    parts.append(ids[at : at + 4 * capacity])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array([len(p) // 4 for p in parts], pa.int64()),
                    pa.array(parts, pa.binary()),
                ],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    kind = docs.select(column(id_col)).dtypes[0][1]
    return docs.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text")).mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids binary"
    )


def _knapsack(price: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value within each amount of room, and the length (by index) that was put in last, or -1."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room], k = best[room - 1], fits[room]
        if k:
            value = price[:k] + best[room - lengths[:k]]
            j = int(value.argmax())
            if value[j] > best[room]:
                best[room], last[room] = value[j], j
    return best, last


def _filling(seed: int, last: np.ndarray, lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple:
    """The best filling that has a piece of length ``seed``, as sorted (index, copies)."""
    used = {seed: 1}
    room = capacity - int(lengths[seed])
    while room > 0:
        j = int(last[room])
        if j < 0 or used.get(j, 0) >= counts[j]:
            room -= 1  # nothing, or nothing more of it, ends here: look at less room
            continue
        used[j] = used.get(j, 0) + 1
        room -= int(lengths[j])
    return tuple(sorted(used.items()))


def fillings(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """How to pack: (number of sequences, [(length, pieces of it in each)])."""
    plan = []
    if histogram.get(capacity):
        plan.append((histogram[capacity], [(capacity, 1)]))
    lengths = np.array(sorted(k for k, n in histogram.items() if n > 0 and k < capacity), np.int64)
    if not len(lengths):
        return plan
    counts = np.array([histogram[int(k)] for k in lengths], np.int64)
    covered, use = np.zeros(len(lengths)), {}
    for _ in range(ROUNDS):
        price = lengths * np.exp(-ETA * covered)
        _, last = _knapsack(price, lengths, capacity)
        seeds = np.argsort(covered, kind="stable")[:PER_ROUND]
        for seed in seeds[covered[seeds] < 1].tolist():
            filling = _filling(seed, last, lengths, counts, capacity)
            at, copies = (np.array(x) for x in zip(*filling))
            amount = STEP * (counts[at] / copies).min()
            use[filling] = use.get(filling, 0.0) + amount
            covered[at] += amount * copies / counts[at]
        if covered.min() >= 1:
            break

    # the stricter the rounding, the more is left for best fit; the fewest sequences win
    rounded = (_rounded(use, lengths, counts, capacity, loss) for loss in (capacity // 512, 0, -1))
    return plan + min(rounded, key=lambda p: sum(times for times, _ in p))


def _rounded(use: dict, lengths: np.ndarray, counts: np.ndarray, capacity: int, loss: int) -> list:
    """Whole fillings from the fractional ones that waste ``loss`` at most, the rest best-fit."""
    plan, left = [], counts.copy()

    def waste(filling: tuple) -> int:
        return capacity - sum(int(lengths[j]) * k for j, k in filling)

    for filling, amount in sorted(use.items(), key=lambda x: (waste(x[0]), -x[1])):
        if waste(filling) > loss:
            break
        times = min(int(np.ceil(amount)), *(int(left[j]) // k for j, k in filling))
        if times > 0:
            plan.append((times, [(int(lengths[j]), k) for j, k in filling]))
            for j, k in filling:
                left[j] -= times * k
    return plan + _best_fit(lengths, left, capacity)


def _best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Fill up what is left: the longest piece, then each time the longest that still fits."""
    plan = []
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return plan
        used, room, k = {}, capacity, len(there)
        while True:
            k = min(k, int(np.searchsorted(lengths[there], room, "right")))
            if not k:
                break
            j = int(there[k - 1])
            fit = min(room // int(lengths[j]), int(left[j]))
            used[j] = fit
            room -= fit * int(lengths[j])
            k -= 1
        times = min(int(left[j]) // c for j, c in used.items())
        plan.append((times, [(int(lengths[j]), c) for j, c in used.items()]))
        for j, c in used.items():
            left[j] -= times * c


def _slots(plan: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """Per length, in order of rank: first rank, first sequence, pieces per sequence, place of the first."""
    slots: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for times, filling in plan:
        place = 0
        for length, copies in filling:
            slots.setdefault(length, []).append((taken.get(length, 0), sequence, copies, place))
            taken[length] = taken.get(length, 0) + times * copies
            place += copies * length
        sequence += times
    return {length: np.array(rows, np.int64).T for length, rows in slots.items()}


def packed(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with sequence_id and offset.

    The plan that goes to all tasks is bounded by the capacity: every filling
    beyond those of the linear program uses up a length.
    """
    pieces = settle(pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(PARTS)).cast("int")), "pieces")
    counts = settle(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(fillings(histogram, capacity))
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = (
        pieces.withColumn("rank", F.row_number().over(W.partitionBy("length", "part").orderBy("doc_id", "piece")) - 1)
        .join(starts, ["length", "part"])
        .withColumn("rank", F.col("rank") + F.col("before"))
        .drop("part", "before")
    )
    places = T.StructType().add("sequence_id", "long").add("offset", "long")

    @F.pandas_udf(places)
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length, rows in lengths.groupby(lengths).groups.items():
            rank = ranks.loc[rows].to_numpy()
            first, base, copies, start = slots[int(length)][:, np.searchsorted(slots[int(length)][0], rank, "right") - 1]
            at = lengths.index.get_indexer(rows)
            sequence[at] = base + (rank - first) // copies
            offset[at] = start + (rank - first) % copies * length
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = ranked.withColumn("place", place("length", "rank")).drop("rank")
    return placed.select(*[c for c in placed.columns if c != "place"], "place.sequence_id", "place.offset")
