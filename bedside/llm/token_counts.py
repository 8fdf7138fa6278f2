"""Token counts under a sentencepiece BPE vocabulary, by rank-synchronous array merging.

A text falls into pre-tokens that no merge can cross: with this kind of
vocabulary a space mark only starts pieces (or stands in runs of space marks), so
a pre-token is a run of space marks and what follows up to the next one; a line
break, which no longer piece holds, ends one too.  Distinct pre-tokens of a batch
are held as ragged arrays of symbol numbers.  One step looks up the rank of every
neighbouring pair, takes each sequence's lowest rank, merges all sequences'
winners at once, and drops finished sequences; the symbols that survive are the
tokens (a symbol outside the vocabulary counts as its UTF-8 bytes).

Most pre-tokens come again and again, so a worker keeps the counts of those it
has seen, in a table of bounded size that only saves time.

Defined cases: null and empty text have 0 bytes and 0 tokens; special strings in
a text are ordinary text; text of any length is one sequence of pre-tokens, and a
single pre-token of any length is merged whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .merges import PairMerges
from .store import column, portions

SPACE = "▁"
#: Pre-tokens a worker remembers, and the longest it remembers.
REMEMBERED, LONGEST = 150_000, 40
#: Bytes of text that are worked on at once.
PORTION = 4 << 20


class PieceRanks:
    """The merges and the character symbols of a vocabulary."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {}
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
                pieces[model.id_to_piece(i)] = (-model.get_score(i), i)
        ordered = sorted(set(cost for cost, _ in pieces.values()))
        rank = {cost: r for r, cost in enumerate(ordered)}
        self.first_free = model.get_piece_size()
        # symbol of each code point; one outside the vocabulary stands for its UTF-8 bytes and merges with nothing
        point = np.arange(0x110000)
        self.symbol = self.first_free + 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)
        for p, (_, i) in pieces.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        if any("\n" in p or SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("the vocabulary has pieces that cross pre-tokens")
        lefts, rights, ranks, made, careful = [], [], [], [], []
        # a pair may be merged at all its places at once unless a piece that
        # continues the result to one side is as urgent as the pair itself
        urgent: dict[str, float] = {}
        for piece, (cost, _) in pieces.items():
            for cut in range(1, len(piece)):
                for part in (piece[:cut], piece[cut:]):
                    urgent[part] = min(urgent.get(part, np.inf), cost)
        for piece, (cost, i) in pieces.items():
            for cut in range(1, len(piece)):
                left, right = pieces.get(piece[:cut]), pieces.get(piece[cut:])
                if left and right:
                    lefts.append(left[1])
                    rights.append(right[1])
                    ranks.append(rank[cost])
                    made.append(i)
                    careful.append(urgent.get(piece, np.inf) <= cost)
        self.merges = PairMerges(lefts, rights, ranks, made, careful)

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols, owner = self.merges.merge(self.symbol[points], np.repeat(np.arange(len(words)), lengths), len(words))
        weight = np.where(symbols > self.first_free, symbols - self.first_free, 1)
        return np.bincount(owner, weight, len(words)).astype(np.int64).tolist()


def pretokens(text: str) -> list[str]:
    """The pre-tokens of a text that is not empty; line breaks are pre-tokens of their own."""
    marked = SPACE + text.replace(SPACE, " ").replace(" ", " " + SPACE).replace("\n", " \n ")
    double, single = SPACE + " " + SPACE, SPACE + SPACE
    while double in marked:
        marked = marked.replace(double, single)
    return [w for w in marked.split(" ") if w]


_RANKS: dict[str, PieceRanks] = {}
_SEEN: dict[str, dict[str, int]] = {}


def count_texts(path: str, texts: list[str | None]) -> list[int]:
    """Tokens of each text; the vocabulary and the counts seen stay with the worker."""
    if path not in _RANKS:
        _RANKS[path], _SEEN[path] = PieceRanks(path), {"\n": 1}
    seen, ranks = _SEEN[path], _RANKS[path]
    if len(seen) > REMEMBERED:
        seen.clear()
        seen["\n"] = 1
    split = [pretokens(t) if t else [] for t in texts]
    new = list({w for words in split for w in words if w not in seen})
    now = dict(zip(new, ranks.counts(new))) if new else {}
    seen.update((w, n) for w, n in now.items() if len(w) <= LONGEST)
    out = []
    for words in split:
        try:
            out.append(sum(map(seen.__getitem__, words)))
        except KeyError:
            out.append(sum(now[w] if w in now else seen[w] for w in words))
    return out


def token_counts(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "text", PORTION):
            texts = batch.column(1)
            tokens = count_texts(path, texts.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.select(column(id_col)).dtypes[0][1]
    return docs.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("text")).mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
