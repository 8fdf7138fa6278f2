"""Rows that share an id, or have none, with unlike texts."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from bedside.llm import mixing, near_dedup

from .fixtures import documents, prose
from .test_operators import _components


def _close(many: int, seed: int = 5) -> list:
    """Texts whose pairwise similarity is a little below and above the limit, so that buckets stay open."""
    base, rows = prose(seed, 200).split(), []
    for i in range(many):
        random.seed(1000 + i)
        words = list(base)
        for k in random.sample(range(200), 9):
            words[k] = f"x{i}.{k}"
        rows.append((i, " ".join(words), "en", "a"))
    return rows


@pytest.mark.parametrize("cell", [256, 3])
def test_near_duplicates_of_ids_with_several_texts(spark, monkeypatch, cell):
    """An id is linked by any of its texts; whichever comes first, nothing breaks and no link is lost."""
    monkeypatch.setattr(near_dedup, "CELL", cell)
    rows = _close(40) + [(2 * i, prose(700 + i, 60), "en", "a") for i in range(20)]
    rows += [(500, rows[50][1], "en", "b"), (501, prose(900, 40), "en", "b"), (501, rows[0][1], "en", "b")]
    sets: dict = {}
    for i, text, *_ in rows:
        words = text.lower().split()
        sets.setdefault(i, []).append({tuple(words[k : k + 2]) for k in range(len(words) - 1)})
    low = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if low[a] != low[b] and any(100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                    low[a] = low[b] = min(low[a], low[b])
                    changed = True
    got = near_dedup.near_duplicates(documents(spark, rows), 2).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == set(low.items()) and len(got) == len(rows)


def test_open_buckets_in_cells(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CELL", 4)
    rows = _close(60, 8)
    want = _components(rows, 2, 80)
    got = near_dedup.near_duplicates(documents(spark, rows), 2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in want.items()}


def test_mixture_is_the_same_on_a_rerun(spark):
    """Half the rows have no id and the others share theirs: the mixed texts do not depend on the partitions."""
    rows = [(None if i % 2 else i % 5, prose(i, 12), None, "ab"[i % 3 == 0]) for i in range(300)]
    table = documents(spark, rows)
    first = Counter((r["doc_id"], r["text"]) for r in mixing.mixture(table).collect())
    again = Counter((r["doc_id"], r["text"]) for r in mixing.mixture(table.repartition(7, "n_chars")).collect())
    assert first == again and sum(first.values()) > 300
