"""Small hand-made documents with the cases every operator must define."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: The columns of documents, and names that operators use for their own work.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, `row` string, `key` string, id long,"
    " size long, length long, part int, rank int, score double, redrawn string, `a.b` string, found string, `group` string"
)


def prose(seed: int, words: int) -> str:
    random.seed(seed)
    parts = "the and ing er tion on re th of to ha in es st en".split()
    return " ".join("".join(random.choices(parts, k=random.randint(1, 3))) for _ in range(words))


def texts() -> list[tuple[int | None, str | None, str | None, str | None]]:
    """(doc_id, text, lang, source)"""
    base = prose(1, 60)
    words = base.split()
    near = " ".join([*words[:30], "changed", *words[31:]])
    far = " ".join(w if i % 3 else "other" for i, w in enumerate(words))
    rows = [
        (1, base, "en", "a"), (2, base.upper(), "en", "a"), (3, near, "en", "b"), (4, far, "en", "b"), (5, None, "en", "c"),
        (6, "", None, "c"), (7, " \n\t ", "de", None), (8, "one", "de", None), (9, "ONE", None, "a"), (10, "12345 !!", "de", "b"),
        (11, prose(2, 9000), "en", "a"), (11, prose(2, 9000), "en", "a"), (None, "no id here", "en", "b"), (None, None, None, None),
        (12, "é   ä<|endoftext|>ß \U0001f600", "de", "é"), (13, "x" * 5000, "en", "a"), (14, "a\u0000b", "en", ""),
    ]
    rows += [(20 + i, prose(50 + i, 5 + 7 * i), "en" if i % 2 else "de", "abc"[i % 3]) for i in range(20)]
    return rows


def documents(spark: SparkSession, rows: list | None = None) -> DataFrame:
    rows = texts() if rows is None else rows
    extra = (True, "r", "k", 7, 8, 9, 10, 11, 0.5, "d", "dot", "f", "g")
    return spark.createDataFrame([(*r, len(r[1] or ""), *extra) for r in rows], SCHEMA).repartition(3)
