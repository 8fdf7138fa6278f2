"""Language identification by unigram models whose segmentations are summed out.

Each language has a probability for every piece of a fixed public vocabulary.  A
word's probability in a language is the sum over all its segmentations into
pieces of the product of their probabilities, which a forward pass over the
positions of the word gives; a text's is the product over its words.  The
probabilities are fitted by expectation maximisation: Spark counts the words per
language, every partition runs forward and backward over its words and sums the
expected uses of pieces, and the driver only normalises the table of pieces by
languages, whose size the vocabulary bounds.

Words are runs of letters with their marks (vowel signs, accents), in lower case; a
letter is what Unicode calls one, so number signs are none.  Words of about equal
length are summed together; sums are scaled as they go along, and a very long word
is read in windows, each of which begins with the positions that the last one left
open, so words and pieces of any length are summed whole.  Most words come again and
again, so a worker keeps the log probabilities of those seen, in a table of bounded
size.

Defined cases: a null text, an empty one and one without any letter are ``und``
with score 0; without training rows every text is; a character outside the
vocabulary has one small probability in all languages; ties go to the language
that sorts first; words of more than ``LEARNED`` letters are scored but not learned from.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import column, hold, settle, small_batches

START = "▁"
#: A word is a letter with all letters, marks and joiners behind it; pieces may begin with a mark.
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}\u200C\u200D]*+")
PIECE = regex.compile(r"[\p{L}\p{M}]+")
UND = "und"
#: Rounds of expectation maximisation, pseudo count of a piece, share of an unknown character.
ROUNDS, PSEUDO, UNKNOWN = 3, 0.05, 1e-7
#: At most about so many labelled rows per language are learned from, chosen by a hash of their id.
SAMPLE = 800
#: Words a worker remembers, letters of the longest of them, and letters of the longest that is learned from.
REMEMBERED, LONGEST, LEARNED = 80_000, 60, 4096
#: Positions that a lattice may have in all its words, those between two scalings, and those of a window in a longer word.
CELLS, SCALED, WINDOW = 1 << 18, 16, 1 << 14


class Pieces:
    """Letter pieces of a vocabulary as a trie in sorted arrays; piece 0 stands for an unknown character."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = (model.id_to_piece(i).lower() for i in range(model.get_piece_size()))
        chosen = sorted({p for p in found if p == START or PIECE.fullmatch(p.removeprefix(START))})
        self.longest = max(map(len, chosen))
        node = {"": 0}
        for p in chosen:
            for end in range(1, len(p) + 1):
                node.setdefault(p[:end], len(node))
        keys = np.array([node[x[:-1]] << 21 | ord(x[-1]) for x in node if x], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.nodes = np.array([n for x, n in node.items() if x], np.int64)[order]
        self.piece = np.full(len(node), -1)
        self.piece[[node[p] for p in chosen]] = np.arange(1, len(chosen) + 1)
        self.size = len(chosen) + 1

    def step(self, node: np.ndarray, point: np.ndarray) -> np.ndarray:
        """The node after one more character, -1 where no piece goes on like that."""
        key = node << 21 | point
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.nodes[at], -1)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _edges(points: np.ndarray, left: np.ndarray, table: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pieces in ``points``: where they begin, how long they are and which; ``left`` is how much of its word a position has."""
    begins, sizes, pieces = [], [], []
    at, node = np.arange(len(left)), np.zeros(len(left), np.int64)
    for size in range(1, table.longest + 1):
        node = table.step(node, points[at + size - 1])
        piece = np.where(node >= 0, table.piece[node], -1)
        if size == 1:
            piece = np.where(piece < 0, 0, piece)  # every character can stand alone
        ok = piece >= 0
        begins.append(at[ok])
        sizes.append(np.full(ok.sum(), size))
        pieces.append(piece[ok])
        on = (node >= 0) & (left[at] > size)
        at, node = at[on], node[on]
    return tuple(np.concatenate(x) for x in (begins, sizes, pieces))


class Lattice:
    """All segmentations of a list of words: edges from begin to end that use a piece.

    Sums are kept as a number and the logarithm of its scale: at every ``SCALED``-th
    position the numbers that later positions need are divided by the largest of them.
    """

    def __init__(self, words: list[str], table: Pieces):
        self.lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.words, self.width, self.reach = len(words), int(self.lengths.max(initial=0)) + 1, table.longest
        points = _points("".join(START + w for w in words))
        word = np.repeat(np.arange(len(words)), self.lengths)
        inside = np.arange(len(points)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        begin, size, self.piece = _edges(points, self.lengths[word] - inside, table)
        cell = word * self.width + inside
        self.begin, self.end = cell[begin], cell[begin] + size
        self.final = np.arange(len(words)) * self.width + self.lengths

    def _sweep(self, share: np.ndarray, origin: np.ndarray, source: np.ndarray, goal: np.ndarray, ahead: bool) -> tuple[np.ndarray, np.ndarray]:
        """Sums over all paths from ``origin``, one position of all words at a time, and the logarithms of their scales."""
        cells, scales = np.zeros((self.words, self.width, share.shape[1])), np.zeros((self.words, self.width, share.shape[1]))
        flat = cells.reshape(-1, share.shape[1])
        flat[origin] = 1.0
        at = goal % self.width
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange(self.width + 1))
        for position in range(1, self.width) if ahead else range(self.width - 1, -1, -1):
            edges = order[cuts[position] : cuts[position + 1]]
            if len(edges):
                np.add.at(flat, goal[edges], flat[source[edges]] * share[self.piece[edges]])
            if position % SCALED == 0 and 0 < position < self.width - 1:
                open_ = slice(max(0, position - self.reach), position + 1) if ahead else slice(position, position + self.reach + 1)
                top = cells[:, open_].max(axis=1, keepdims=True)
                top[top <= 0] = 1.0
                cells[:, open_] /= top
                scales[:, open_] += np.log(top)
                if ahead:
                    scales[:, position + 1 :] += np.log(top)
                    # a word that ends here is done: what is behind its end is not read
                else:
                    scales[:, :position] += np.log(top)
        return flat, scales.reshape(-1, share.shape[1])

    def forward(self, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._sweep(share, np.arange(self.words) * self.width, self.begin, self.end, True)

    def log_words(self, share: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language."""
        cells, scales = self.forward(share)
        return np.log(cells[self.final]) + scales[self.final]

    def expected(self, share: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in each language; ``counts`` has a word's count per language."""
        ahead, before = self.forward(share)
        behind, after = self._sweep(share, self.final, self.end, self.begin, False)
        word = self.begin // self.width
        whole = (np.log(ahead[self.final]) + before[self.final])[word]
        scale = np.exp(before[self.begin] + after[self.end] - whole)
        use = ahead[self.begin] * share[self.piece] * behind[self.end] * scale * counts[word]
        out = np.zeros_like(share)
        np.add.at(out, self.piece, use)
        return out


def log_long(word: str, table: Pieces, share: np.ndarray) -> np.ndarray:
    """Log probability of one very long word: windows that carry the positions the last one left open."""
    points = _points(START + word)
    carry, scale = np.zeros((table.longest + 1, share.shape[1])), np.zeros(share.shape[1])
    carry[0] = 1.0
    for at in range(0, len(points), WINDOW):
        many = min(WINDOW, len(points) - at)
        left = np.minimum(len(points) - at - np.arange(many), table.longest)
        begin, size, piece = _edges(points[at : at + many + table.longest], left, table)
        order = np.argsort(begin, kind="stable")
        cuts = np.searchsorted(begin[order], np.arange(many + 1))
        cells = np.zeros((many + table.longest + 1, share.shape[1]))
        cells[: table.longest + 1] = carry
        for position in range(many):
            edges = order[cuts[position] : cuts[position + 1]]
            # edges of one position have different lengths, so no goal comes twice
            cells[position + size[edges]] += cells[position] * share[piece[edges]]
            if position % SCALED == 0:
                open_ = cells[position + 1 : position + table.longest + 1]
                top = open_.max(axis=0)
                open_ /= top
                scale += np.log(top)
        carry = cells[many : many + table.longest + 1]
    return np.log(carry[0]) + scale


def grouped(words: list[str]) -> Iterator[np.ndarray]:
    """Places of words of about equal length, as many as have ``CELLS`` positions together; a longer word alone."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        reach = np.arange(1, len(order) - at + 1) * lengths[order[at:]]
        many = max(1, int(np.searchsorted(reach, CELLS, "right")))
        yield order[at : at + many]
        at += many


def log_words(words: list[str], table: Pieces, share: np.ndarray) -> np.ndarray:
    """Log probability of each of any words in each language."""
    out = np.zeros((len(words), share.shape[1]))
    for places in grouped(words):
        if len(places) == 1 and len(words[places[0]]) > WINDOW:
            out[places[0]] = log_long(words[places[0]], table, share)
        else:
            out[places] = Lattice([words[i] for i in places], table).log_words(share)
    return out


@dataclass
class LanguageModel:
    """Languages, pieces and their probabilities per language."""

    languages: list[str]
    table: Pieces
    share: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its posterior probability (equal priors) for each text."""
        if not self.languages:
            return [UND] * len(texts), [0.0] * len(texts)
        seen = _seen(self.name, len(self.languages))
        languages, scores = [], []
        split = [_words(t) for t in texts]
        long = {w for words in split for w in words if len(w) > LONGEST}
        seen.add(list({w for words in split for w in words if w not in seen.place and w not in long}), self)
        apart = dict(zip(long, log_words(list(long), self.table, self.share)))
        for words in split:
            if not words:
                languages.append(UND)
                scores.append(0.0)
                continue
            usual = [seen.place[w] for w in words if w not in apart] if apart else list(map(seen.place.__getitem__, words))
            log = seen.rows[np.array(usual, np.int64)].sum(axis=0) + sum((apart[w] for w in words if w in apart), 0.0)
            best = int(log.argmax())
            languages.append(self.languages[best])
            scores.append(float(1 / np.exp(log - log[best]).sum()))
        return languages, scores


class _Seen:
    def __init__(self, languages: int):
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1024, languages))

    def add(self, words: list[str], model: LanguageModel) -> None:
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            used = len(self.place)
            if used + len(part) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((max(len(self.rows), len(part)), self.rows.shape[1]))])
            self.rows[used : used + len(part)] = log_words(part, model.table, model.share)
            self.place.update(zip(part, range(used, used + len(part))))


_SEEN: dict[str, _Seen] = {}


def _seen(name: str, languages: int) -> _Seen:
    hold("language", _SEEN.clear)
    if name not in _SEEN or len(_SEEN[name].place) > REMEMBERED:
        _SEEN.clear()  # the words of an earlier model are of no use
        _SEEN[name] = _Seen(languages)
    return _SEEN[name]


def _words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def _sampled(rows: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` rows per language by a hash of their id; all where there are fewer."""
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    many = {lang: sample / n for lang, n in counts.items() if n > sample}
    if not many:
        return rows
    share = F.coalesce(F.create_map(*[F.lit(x) for pair in many.items() for x in pair])[F.col("lang")], F.lit(1.0))
    return rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 20)) < share * (1 << 20))


def fit(
    docs: DataFrame,
    path: str,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel:
    """Learn from the rows of ``docs`` that have a text and a language."""
    small_batches(docs.sparkSession)
    rows = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text"), column(lang_col).alias("lang"))
    rows = _sampled(rows.filter("text is not null and lang is not null"), sample)
    table = Pieces(path)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, str], int] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in _words(text):
                    if len(w) <= LEARNED:
                        counts[lang, w] = counts.get((lang, w), 0) + 1
            langs, found = zip(*counts) if counts else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(found, pa.string()), pa.array(counts.values(), pa.int64())],
                ["lang", "word", "n"],
            )

    counted = settle(
        rows.select("text", "lang").mapInArrow(words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "lang-words",
    )
    languages = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    model = LanguageModel(languages, table, np.full((table.size, max(1, len(languages))), 1.0 / table.size))
    model.share[0] = UNKNOWN
    for _ in range(ROUNDS if languages else 0):
        uses = counted.mapInArrow(_expectations(model), "piece int, lang int, n double")
        found = uses.groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas().sort_values(["piece", "lang"])
        total = np.full(model.share.shape, PSEUDO)
        total[found["piece"], found["lang"]] += found["n"]
        share = total / total.sum(axis=0)
        share[0] = UNKNOWN
        model = LanguageModel(languages, table, share)
    return model


def _expectations(model: LanguageModel):
    number = {lang: i for i, lang in enumerate(model.languages)}

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(model.share)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                langs = np.array([number[x] for x in part.column(0).to_pylist()])
                counts = np.zeros((part.num_rows, len(number)))
                counts[np.arange(part.num_rows), langs] = part.column(2).to_numpy()
                found = part.column(1).to_pylist()
                for places in grouped(found):
                    total += Lattice([found[i] for i in places], model.table).expected(model.share, counts[places])
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])], ["piece", "lang", "n"]
        )

    return expect


def lettered(text: Column) -> Column:
    """Whether a text column has a letter, so that it has a language, known or not."""

    @F.pandas_udf("boolean")
    def any_letter(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: isinstance(t, str) and bool(LETTERS.search(t.lower()))).astype(bool)

    return any_letter(text)


def identified(model: LanguageModel, text: Column) -> Column:
    """A struct of lang_pred and score for a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        languages, scores = [], []
        for at in range(0, len(texts), 256):
            part = model.predict([t if isinstance(t, str) else None for t in texts.iloc[at : at + 256]])
            languages += part[0]
            scores += part[1]
        return pd.DataFrame({"lang_pred": languages, "score": scores})

    return predict(text)
