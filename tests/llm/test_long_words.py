"""Letters, marks, long pieces and long words of the language operator."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from bedside.llm import language

from .fixtures import documents, prose


@pytest.fixture(scope="module")
def table():
    return language.Pieces(public_tokenizers.path("piece_bpe_32k.model"))


def test_words_are_letters_with_their_marks():
    assert [language._words(t) for t in ("½", "²①Ⅷ", "12 _ !", "", None, "€")] == [[]] * 6
    assert language._words("नमस्ते दुनिया") == ["नमस्ते", "दुनिया"]
    assert language._words("Été l'año x2y") == ["été", "l", "año", "x", "y"]


def _total(points, table, share):
    """Log of the sum over all segmentations, position by position in logarithms, with no cap."""
    word, out = language.START + points, [np.zeros(share.shape[1])]
    for end in range(1, len(word) + 1):
        terms = []
        for begin in range(max(0, end - table.longest), end):
            node = np.zeros(1, np.int64)
            for c in word[begin:end]:
                node = table.step(node, np.array([ord(c)])) if node[0] >= 0 else node
            piece = int(table.piece[node[0]]) if node[0] >= 0 else -1
            if piece < 0 and end - begin == 1:
                piece = 0
            if piece >= 0:
                terms.append(out[begin] + np.log(share[piece]))
        out.append(np.logaddexp.reduce(terms, axis=0))
    return out[-1]


def test_any_piece_and_word_is_summed_whole(table, monkeypatch):
    """Pieces up to the longest of the vocabulary; words longer than every window and scale."""
    assert table.longest > 12
    share = np.random.default_rng(0).random((table.size, 3)) / table.size
    share[0] = language.UNKNOWN
    words = ["a", "international", "straightforward" * 9, "日本" * 40, "x" * 300, "ςδ" * 333 + "thionering", "neighbourhood"]
    want = np.array([_total(w, table, share) for w in words])
    np.testing.assert_allclose(language.log_words(words, table, share), want, rtol=1e-9)
    monkeypatch.setattr(language, "CELLS", 64)  # every word alone
    np.testing.assert_allclose(language.log_words(words, table, share), want, rtol=1e-9)
    for window in (17, 64, 100):
        monkeypatch.setattr(language, "WINDOW", window)
        np.testing.assert_allclose(language.log_words(words, table, share), want, rtol=1e-9)


def test_expected_uses_of_long_words(table):
    """A word's expected uses cover each of its characters once, however long it is."""
    share = np.random.default_rng(1).random((table.size, 2)) / table.size
    size = np.ones(table.size)
    for key, node in zip(table.keys, table.nodes):
        if table.piece[node] > 0:
            size[table.piece[node]] = -1
    length = {0: 0}
    for key, node in sorted(zip((table.keys >> 21).tolist(), table.nodes.tolist())):
        length[node] = length.get(key, 0) + 1
    for node, n in length.items():
        if table.piece[node] > 0:
            size[table.piece[node]] = n
    words, counts = ["thering" * 40, "in", "日" * 500], np.array([[1.0, 2.0], [3.0, 0.0], [0.0, 1.0]])
    used = language.Lattice(words, table).expected(share, counts)
    want = sum(c * (len(w) + 1) for w, c in zip(words, counts))
    np.testing.assert_allclose((used * size[:, None]).sum(axis=0), want, rtol=1e-9)


def test_texts_of_one_long_word(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    north = [(100 + i, prose(i, 40), "north", None) for i in range(20)]
    south = [(200 + i, prose(i, 40).replace("th", "que").replace("e", "ó"), "south", None) for i in range(20)]
    model = language.fit(documents(spark, north + south), path)
    texts = ["".join(prose(77, 9000).split()), "".join(prose(78, 9000).replace("th", "que").replace("e", "ó").split()), "½ ² ①"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = {r["id"]: r["p"] for r in rows.select("id", language.identified(model, F.col("text")).alias("p")).collect()}
    assert [found[i]["lang_pred"] for i in range(3)] == ["north", "south", "und"] and found[2]["score"] == 0
