"""Whitening of embeddings by a covariance over distinct vectors, weighted with their copies.

Components become whole numbers, so equal vectors are equal bytes: rows are grouped
by them with a map-side combined count, and all later work is done once per
distinct vector.  Sums per dimension are exact.  The covariance is the product of
the centred matrix with itself, its rows weighted with the copies (or with one
each): a task multiplies its batches, and the tasks' matrices are added up row by
row of the matrix.  Its eigenvectors give the components.  What the driver holds is
the matrix of one row per dimension.  Every distinct vector is then projected and
scaled, and rows get their result by a join on the hash of their vector.

A vector with more than 1/256 of all rows would make a hot key of that join.  There
are fewer than 256 of these, so their results go to every task instead and only the
other rows are shuffled.

Defined cases: a row with a null vector or a null or non-finite component takes no
part; a shorter vector counts as padded with zeros; scaled components beyond 2^52
stop there; a row without id and a repeated row are rows like others; a direction
without variance (below 1e-11 of the largest) has no whitened value, null; the
share explained is null where nothing varies; the deviation is null beyond 38
digits; an empty table, or one of empty vectors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import column, settle, small_batches

#: Vectors with more than this part of all rows are joined by broadcast: fewer than SHARES of them exist.
SHARES = 256
#: Variance, as a part of the largest, below which a direction counts as without any.
FLAT = 1e-11
LIMIT = 2.0**52


def _finite(values: Column) -> Column:
    return F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _whole(vectors: pa.Array, width: int, scale: float, shift: int) -> np.ndarray:
    """Rows of ``floor(scale * c) + shift``."""
    lengths = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(lengths), width))
    with np.errstate(over="ignore"):
        out[np.arange(width) < lengths[:, None]] = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * scale)
    return np.clip(out, -LIMIT, LIMIT).astype(np.int64) + shift


def _matrix(packed: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed.to_pylist()), "<i8").reshape(-1, width)


def _sums(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Exact weighted sums per dimension of a task's vectors; in the last place the weight itself."""
    total = [0] * (width + 1)
    for batch in batches:
        x, weight = _matrix(batch.column(0), width), batch.column(1).to_numpy()
        if int(np.abs(x).max(initial=0)) * int(weight.sum()) >= 2**63:
            x, weight = x.astype(object), weight.astype(object)
        for i, s in enumerate([*(weight @ x).tolist(), weight.sum()] if len(x) else []):
            total[i] += int(s)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(width + 1), pa.int32()), pa.array([Decimal(s) for s in total], pa.decimal128(38, 0))], ["place", "total"]
    )


def _centred(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """x - S / n; the whole part of the mean goes first, exactly."""
    mean = [divmod(s, n) for s in sums]
    return (x - np.array([q for q, _ in mean], np.int64)) - np.array([r / n for _, r in mean])


def _deviations(x: np.ndarray, sums: list[int], n: int) -> list[int]:
    """Sum over dimensions of (n * x - S)^2, exactly."""
    reach = max([n * int(abs(v)) + abs(s) for v, s in zip(np.abs(x).max(0, initial=0), sums)], default=0)
    s = np.array(sums, np.int64 if reach < 2**62 else object)
    apart = x.astype(s.dtype) * n - s
    if int(np.abs(apart).max(initial=0)) ** 2 * x.shape[1] >= 2**63:
        apart = apart.astype(object)
    return (apart**2).sum(1).tolist()


def _product(matrices: Iterator[tuple[np.ndarray, np.ndarray]], width: int) -> Iterator[pa.RecordBatch]:
    """The weighted product of a task's matrices with themselves, a row of it per row."""
    total = np.zeros((width, width))
    for x, weight in matrices:
        total += (x * weight[:, None]).T @ x
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(width), pa.int32()), pa.array([r.tobytes() for r in total.astype("<f8")], pa.binary())], ["place", "line"]
    )


def _added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of the product from those of all tasks, as they come."""
    total = None
    for batch in batches:
        for line in batch.column("line").to_pylist():
            values = np.frombuffer(line, "<f8")
            total = values.copy() if total is None else total + values
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["place", "line"])


def _gathered(products: DataFrame) -> np.ndarray:
    """The sum of the tasks' products: as many rows as there are dimensions."""
    lines = sorted(map(tuple, products.groupBy("place").applyInArrow(_iterating(_added), "place int, line binary").collect()))
    return np.stack([np.frombuffer(line, "<f8") for _, line in lines])


def _iterating(f):
    """Type hints by which Spark hands over a group batch by batch instead of whole."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return f(key, batches)

    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return run


def principal(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest eigenvalues in falling order, their unit eigenvectors as columns, and which of them are not flat."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return values, vectors, (values > 0) & (values > FLAT * values.max(initial=0))


def whitened(
    vectors: DataFrame,
    components: int = 8,
    weights: str = "counts",
    scale: float = 1024.0,
    shift: int = 100_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per row and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    With ``weights="counts"`` the fit is over all rows, with ``"ones"`` over distinct vectors.
    """
    if weights not in ("counts", "ones"):
        raise ValueError("weights is counts or ones")
    spark = vectors.sparkSession
    small_batches(spark)
    rows = vectors.select(column(id_col).cast("long").alias("vec_id"), column(vector_col).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vector").isNotNull() & _finite(F.col("vector")))
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    if not width:
        out = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return spark.createDataFrame([], out)
    components = min(components, width)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _whole(batch.column(1), width, scale, shift).astype("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in whole], pa.binary())], ["vec_id", "packed"])

    keyed = rows.mapInArrow(pack, "vec_id long, packed binary").withColumn("key", F.unhex(F.sha2("packed", 256)))
    keyed = settle(keyed, "vectors")
    weight = F.col("copies") if weights == "counts" else F.lit(1).cast("long")
    distinct = keyed.groupBy("key", "packed").agg(F.count(F.lit(1)).alias("copies")).withColumn("weight", weight)
    distinct = settle(distinct, "distinct-vectors")
    totals = distinct.select("packed", "weight").mapInArrow(partial(_sums, width=width), "place int, total decimal(38,0)")
    *sums, n = [int(t) for _, t in sorted(map(tuple, totals.groupBy("place").agg(F.sum("total")).collect()))]  # a row per dimension

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ((_centred(_matrix(b.column(0), width), sums, n), b.column(1).to_numpy()) for b in batches if b.num_rows)
        return _product(pairs, width)

    covariance = _gathered(distinct.select("packed", "weight").mapInArrow(multiply, "place int, line binary")) / n
    values, directions, live = principal(covariance, components)
    with np.errstate(divide="ignore", invalid="ignore"):
        projection = directions / np.where(live, np.sqrt(values), np.nan)
    trace = float(np.trace(covariance))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), width)
            apart = [Decimal(v) if v < 10**38 else None for v in _deviations(x, sums, n)]
            flat = (_centred(x, sums, n) @ projection).ravel()
            offsets = pa.array(np.arange(len(x) + 1) * components, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.float64(), mask=np.isnan(flat)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(apart, pa.decimal128(38, 0)), lists],
                ["key", "copies", "weight", "deviation", "whitened"],
            )

    schema = "key binary, copies long, weight long, deviation decimal(38,0), whitened array<double>"
    done = settle(distinct.select("key", "packed", "copies", "weight").mapInArrow(project, schema), "whitened")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """With a column of ones the product holds the sums as well."""
        lists = ((b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), b.column(0)) for b in batches if b.num_rows)
        pairs = ((np.c_[np.where(live, y, 0.0), np.ones(len(y))], w.to_numpy()) for y, w in lists)
        return _product(pairs, components + 1)

    second = _gathered(done.select("weight", "whitened").mapInArrow(moments, "place int, line binary")) / n
    off = second[:-1, :-1] - np.outer(second[-1, :-1], second[-1, :-1]) - np.diag(live.astype(float))
    error = float(np.abs(off).max()) if live.any() else None

    many = done.agg(F.sum("copies")).first()[0]
    found = done.select("key", "copies", "deviation", "whitened")
    often = F.broadcast(found.filter(F.col("copies") * SHARES > many))  # fewer than SHARES rows
    mine = keyed.select("vec_id", "key")
    seldom = mine.join(often.select("key"), "key", "left_anti").join(found, "key")
    joined = mine.join(often, "key").unionByName(seldom)
    share = F.array(*[F.lit(float(v) / trace if trace > 0 else None).cast("double") for v in values])
    return joined.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(share, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
