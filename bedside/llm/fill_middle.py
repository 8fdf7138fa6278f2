"""Fill-in-the-middle: texts cut at unit ends by a wavelet matrix over character classes.

Every character has one of four classes: a new line, another blank, the last
character of a word, or a character inside a word.  A wavelet matrix over these
classes answers how often a class occurs before a place (rank).  Units end behind
certain classes (lines behind new lines, words behind last characters, characters
behind any), so the sum of the ranks of these classes counts the unit ends before a
place, and bisection on that count finds the place behind the u-th end (select).
One matrix serves all texts of a portion: the ends before a text's first character
are subtracted, and both cuts of all texts are found together.

The hash of seed and id picks two unit ends and the form.  ``psm`` is
``<P>prefix<S>suffix<M>middle``, ``spm`` is ``<S>suffix<P>prefix<M>middle``, ``plain`` is
the text as it is.  :func:`restored` gives the text back from output and form.

Texts stay where they are: nothing is shuffled, and a worker holds one portion.  A
matrix takes two bits per class bit and character, so one very long text is only
as large as itself with its code points.

Defined cases: null text is empty; an empty text and one that contains a marker are
plain; a row without id hashes the empty string in its place; repeated rows come
out alike, as often as they come in; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import column, portions, small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
BLANK, NEWLINE, INNER, END = range(4)
#: The classes behind which a unit ends; what is left behind the last end is a unit too.
CLOSES = {"lines": (NEWLINE,), "words": (END,), "characters": (BLANK, NEWLINE, INNER, END)}
#: Bytes of text that share a matrix; a longer single text has its own.
PORTION = 1 << 21


class WaveletMatrix:
    """Rank over a sequence of small numbers, one packed bit vector per binary digit."""

    def __init__(self, symbols: np.ndarray, digits: int):
        self.levels = []
        for digit in reversed(range(digits)):
            ones = (symbols >> digit & 1).astype(bool)
            packed = np.zeros(len(ones) // 64 * 8 + 8, np.uint8)
            packed[: -(-len(ones) // 8)] = np.packbits(ones, bitorder="little")
            words = packed.view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((digit, words, before, len(ones) - int(before[-1])))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & below).astype(np.int64)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are ``symbol``, for an array of places."""
        first, at = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for digit, words, before, zeros in self.levels:
            ones = [self._ones(words, before, x) for x in (first, at)]
            first, at = (zeros + ones[0], zeros + ones[1]) if symbol >> digit & 1 else (first - ones[0], at - ones[1])
        return at - first


def classes(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of each code point; ``ends`` are the places behind each text."""
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    closing = np.append(blank[1:], True)
    closing[ends[ends > 0] - 1] = True
    return np.where(codes == 10, NEWLINE, np.where(blank, BLANK, np.where(closing, END, INNER))).astype(np.uint8)


class Boundaries:
    """Unit ends of several texts laid end to end."""

    def __init__(self, texts: list[str], units: str):
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.closes = CLOSES[units]
        self.matrix = WaveletMatrix(classes(codes, self.ends), 2)
        self.before = self.count(self.starts)
        self.closed = self.count(self.ends) - self.before
        last = np.where(self.ends > self.starts, self.ends - 1, self.starts)
        self.rest = (self.ends > self.starts) & (self.count(self.ends) == self.count(last))

    def count(self, at: np.ndarray) -> np.ndarray:
        """Unit ends among the first ``at`` characters."""
        return sum(self.matrix.rank(c, at) for c in self.closes)

    @property
    def units(self) -> np.ndarray:
        return self.closed + self.rest

    def behind(self, unit: np.ndarray) -> np.ndarray:
        """The place in its text behind the first ``unit`` units of each text."""
        low, high = self.starts.copy(), self.ends.copy()
        wanted = self.before + unit
        while (low < high).any():  # the first place with as many ends before it
            middle = (low + high) >> 1
            enough = self.count(middle) >= wanted
            low, high = np.where(enough, low, np.minimum(middle + 1, high)), np.where(enough, middle, high)
        return np.where(unit > self.closed, self.ends, low) - self.starts


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the hash of seed and id."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digits[i : i + 8], 16) for i in range(0, 32, 8))


def fill_in_middle(
    docs: DataFrame,
    units: str = "lines",
    seed: int = 7,
    rate: int = 100,
    spm: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, n (units), form, prefix_chars, middle_chars (null if plain), output.

    ``rate`` is the share of texts in percent that are rearranged, ``spm`` the share of
    these with the suffix first.
    """
    if units not in CLOSES:
        raise ValueError(f"units is one of {', '.join(CLOSES)}")
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text", PORTION):
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            found = Boundaries(texts, units)
            drawn = [draws(seed, i) for i in ids]
            many = found.units + 1
            one, other = (np.array([d[k] for d in drawn], np.int64) % many for k in (0, 1))
            first, second = found.behind(np.minimum(one, other)), found.behind(np.maximum(one, other))
            forms, outputs = [], []
            for text, d, a, b in zip(texts, drawn, first.tolist(), second.tolist()):
                if not text or d[2] % 100 >= rate or any(m in text for m in MARKS):
                    forms.append("plain")
                    outputs.append(text)
                elif d[3] % 100 < spm:
                    forms.append("spm")
                    outputs.append(SUFFIX + text[b:] + PREFIX + text[:a] + MIDDLE + text[a:b])
                else:
                    forms.append("psm")
                    outputs.append(PREFIX + text[:a] + SUFFIX + text[b:] + MIDDLE + text[a:b])
            plain = np.array([f == "plain" for f in forms], bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(found.units, pa.int64()), pa.array(forms, pa.string()),
                    pa.array(first, pa.int64(), mask=plain), pa.array(second - first, pa.int64(), mask=plain),
                    pa.array(outputs, pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made from.

    A rearranged text holds no marker, and a marker can't begin inside another or end in
    a text, so the three markers are the only places where the pattern fits.
    """
    part = F.split(output, "<[PSM]>")
    first, second, third = (F.get(part, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, third, second)).when(form == "spm", F.concat(second, third, first)).otherwise(output)
