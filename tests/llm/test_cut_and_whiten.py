"""Fill-in-the-middle, sharding and whitening against plain definitions."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from bedside.llm import fill_middle, sharding, whitening

from .fixtures import SCHEMA, documents, texts

UNITS = {"lines": r"[^\n]*\n|[^\n]+", "words": r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", "characters": r"(?s:.)"}


# ---- fill in the middle


def cut(text, doc_id, units, rate, spm):
    parts = re.findall(UNITS[units], text)
    digits = sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(parts) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(p) for p in (parts[:a], parts[a:b], parts[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(parts), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(parts), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(parts), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = [
    "\n", "\n\n\n", "a\nb", "a\nb\n", "\r\n\r\nx", "é\U0001f600\nß\n", "x <P> y\nz", "<S>", "<M>\n", "< P>\n<<\nS>\n", "a b\u0085c\nd",
    "a\u0000\nb\u0000", " lead\n trail ", "<P", "line\n" * 3000, ">\n<\n>\n<", "́\n​",
]


@pytest.mark.parametrize("units, rate, spm", [("lines", 100, 50), ("words", 100, 50), ("characters", 60, 30)])
def test_fill_in_middle(spark, units, rate, spm):
    rows = texts() + [(1000 + 10 * i + k, t, None, None) for i, t in enumerate(ODD) for k in range(5)]
    found = fill_middle.fill_in_middle(documents(spark, rows), units, rate=rate, spm=spm)
    found = found.withColumn("again", fill_middle.restored(F.col("form"), F.col("output"))).collect()
    want = Counter((i, *cut(t or "", i, units, rate, spm), t or "") for i, t, *_ in rows)
    assert Counter(map(tuple, found)) == want
    assert {r["form"] for r in found} == {"plain", "spm", "psm"}


def test_fill_in_middle_of_nothing(spark):
    assert fill_middle.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(documents(spark), units="pages")


def test_wavelet_matrix_counts():
    random = np.random.default_rng(4)
    for n in (1, 63, 64, 65, 1000):
        symbols = random.integers(0, 4, n).astype(np.uint8)
        matrix = fill_middle.WaveletMatrix(symbols, 2)
        for s in range(4):
            assert (matrix.rank(s, np.arange(n + 1)) == np.concatenate([[0], np.cumsum(symbols == s)])).all()


# ---- sharding


def plain_shards(sizes: dict[str, int], shards: int) -> dict[str, int]:
    """The same law over a whole list of groups: smallest capacity by trying, cuts by walking."""
    alone, left = [], sum(sizes.values())
    for key in sorted(sizes, key=lambda k: (-sizes[k], k)):
        if len(alone) + 1 >= shards or sizes[key] * (shards - len(alone)) <= left:
            break
        alone.append(key)
        left -= sizes[key]
    out = {k: i for i, k in enumerate(alone)}
    rest = sorted(k for k in sizes if k not in out)
    many, edges = shards - len(alone), [0]
    for k in rest:
        edges.append(edges[-1] + sizes[k])
    if not rest:
        return out

    def fits(capacity):
        at = 0
        for _ in range(many):
            at = max(e for e in edges if e <= at + capacity)
        return at == edges[-1]

    capacity = max(-(-edges[-1] // many), *(sizes[k] for k in rest))
    while not fits(capacity):
        capacity += 1
    earliest = [edges[-1]]
    for _ in range(many - 1):
        earliest.append(min(e for e in edges if e >= max(0, earliest[-1] - capacity)))
    at, ends = 0, []
    for k in range(1, many):
        share = at + -(-(edges[-1] - at) // (many - k + 1))
        at = max(e for e in edges if e <= min(at + capacity, max(earliest[many - k], share)))
        ends.append(at)
    for i, k in enumerate(rest):
        out[k] = len(alone) + sum(e <= edges[i] for e in ends)
    loads = Counter()
    for k in rest:
        loads[out[k]] += sizes[k]
    assert max(loads.values()) <= capacity
    return out


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_that_over_all_groups(spark, seed, monkeypatch):
    """Also where first segments hold many groups and have to be divided."""
    monkeypatch.setattr(sharding, "FIRST", 1 + seed % 3)
    monkeypatch.setattr(sharding, "MORE", 1)
    random = np.random.default_rng(seed)
    many = (1, 3, 40, 300, 700, 300)[seed]
    sizes = {sha256(f"{seed}/{i}".encode()).hexdigest()[:32]: int(random.integers(8, 60)) for i in range(many)}
    if seed > 3:  # a group of a third of all, one of a tenth
        big = sorted(sizes)[:: many // 2][:2]
        sizes[big[0]], sizes[big[1]] = sum(sizes.values()) // 2, sum(sizes.values()) // 8
    shards = (24, 24, 5, 24, 7, 1)[seed]
    plan = sharding.planned(spark.createDataFrame(list(sizes.items()), "key string, size long"), shards)
    keys = spark.createDataFrame([(k,) for k in sizes], "key string")
    assert dict(map(tuple, keys.select("key", plan.shard(F.col("key"))).collect())) == plain_shards(sizes, shards)


def test_sharded_rows(spark, tmp_path):
    rows = texts() + [(200 + i, "copy of one text " * 40, None, None) for i in range(60)] + [(None, "again", None, None)] * 30
    docs = documents(spark, rows)
    found = sharding.sharded(docs, 6).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}
    slots: dict[int, list] = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) <= set(range(6)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes: dict[str, int] = Counter()
    for _, t, *_ in rows:
        sizes[sha256((t or "").encode()).hexdigest()[:32]] += len((t or "").encode()) + 8
    want = plain_shards(sizes, 6)
    assert Counter(r["shard"] for r in found) == Counter(want[sha256((t or "").encode()).hexdigest()[:32]] for _, t, *_ in rows)

    clash = docs.withColumn("shard", F.lit("mine"))
    name = sharding.write_shards(clash, str(tmp_path / "out"), 6)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert name == "shard_" and set(back.columns) == {*clash.columns, name} and back.filter("shard = 'mine'").count() == len(rows)
    key = F.coalesce("text", F.lit(""))
    assert {(r[0], r[1]) for r in back.select(F.substring(F.sha2(key, 256), 1, 32), name).collect()} == set(want.items())
    assert sharding.sharded(spark.createDataFrame([], SCHEMA), 6).count() == 0


# ---- whitening

VECTORS = "vec_id long, embedding array<float>, key string, copies int, weight int, n long, place int, whitened string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, 3, 4, "w") for r in rows], VECTORS).repartition(4)


def plain_whitened(rows, width, weights="counts"):
    """Per row its id, deviation and whitened components from the whole matrix; n; shares."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = [tuple(int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in [*v, *[0.0] * (width - len(v))]) for _, v in kept]
    fit = x if weights == "counts" else sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(a - s / n) for a, s in zip(r, sums)] for r in fit])
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:8], directions[:, ::-1][:, :8]
    out = []
    for (i, _), r in zip(kept, x):
        deviation = sum((n * a - s) ** 2 for a, s in zip(r, sums))
        out.append((i, deviation, (np.array([a - s / n for a, s in zip(r, sums)]) @ directions) / np.sqrt(values)))
    return out, n, values / (centred**2).sum() * n


@pytest.mark.parametrize("weights", ["counts", "ones"])
def test_whitened(spark, weights):
    random = np.random.default_rng(8)
    spread = random.normal(size=(12, 12))
    rows = [(i, [float(np.float32(c)) for c in spread @ random.normal(size=12)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [rows[1]] * 5 + [(None, rows[2][1]), (None, rows[2][1]), (7, rows[9][1])]
    odd = [(2000, None), (2001, [None, *[1.0] * 11]), (2002, [float("nan")] * 12), (2003, [float("inf"), *[0.0] * 11]), (2004, [0.5, -0.5]), (2005, [])]
    found = whitening.whitened(vectors(spark, rows + odd), weights=weights).collect()
    want, n, share = plain_whitened(rows + odd, 12, weights)
    assert len(found) == 8 * len(want) and {r["n"] for r in found} == {n}
    for r in found:
        assert r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-9)
    assert {r["identity_error"] < 1e-9 for r in found} == {True}
    got: dict = {}
    for r in found:
        got.setdefault(r["component"], []).append((r["vec_id"] is None, r["vec_id"] or 0, int(r["deviation"]), r["whitened"]))
    for c, cells in got.items():
        plain = sorted((i is None, i or 0, d, float(y[c - 1])) for i, d, y in want)
        cells.sort()
        assert [x[:3] for x in cells] == [x[:3] for x in plain]
        a, b = (np.array([x[3] for x in t]) for t in (cells, plain))
        assert np.allclose(np.abs(a), np.abs(b), atol=1e-9)


def test_whitened_flat_and_huge(spark):
    """Directions without variance are null; sums and deviations are exact beyond 64 bits."""
    rows = [(i, [float(i % 5), 3.0, float(i % 2)]) for i in range(20)]
    found = whitening.whitened(vectors(spark, rows)).collect()
    assert {r["whitened"] is None for r in found if r["component"] == 3} == {True} and len(found) == 60
    assert all(r["whitened"] is not None for r in found if r["component"] < 3) and found[0]["identity_error"] < 1e-9
    one = whitening.whitened(vectors(spark, [(1, [2.0, 3.0])] * 3)).collect()
    assert {(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in one} == {(None, None, None, 0)} and len(one) == 6
    far = [(i, [3e38 if i % 2 else -3e38, float(i)]) for i in range(10)]
    limit = 2**52
    wide = whitening.whitened(vectors(spark, far)).filter("component = 1").collect()
    sums = [10 * 100_000, sum(1024 * i + 100_000 for i in range(10))]
    for r in wide:
        x = [(limit if r["vec_id"] % 2 else -limit) + 100_000, 1024 * r["vec_id"] + 100_000]
        assert int(r["deviation"]) == sum((10 * a - s) ** 2 for a, s in zip(x, sums))
    assert whitening.whitened(vectors(spark, [])).count() == 0
    assert whitening.whitened(vectors(spark, [(1, []), (2, None)])).count() == 0
    with pytest.raises(ValueError):
        whitening.whitened(vectors(spark, []), weights="some")
