"""Exact top-k search by inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance from it; distances
are cut into annuli, and a (pivot, annulus) cell keeps the exact range of its
distances and its largest norm.  The triangle inequality bounds a query's distance
to anything in a cell from below, and ``2 q.x = |q|^2 + |x|^2 - |q - x|^2`` turns that
into a bound on the score from above.  A query first looks at its most promising
cells; after that it needs only those whose bound reaches the k-th best score it
has, and all others are skipped.  Pivots and annuli come from a bounded sample;
every row is in the index and results are exact.

Cells are packed into blocks of bounded size, queries of one pivot into chunks, and
a block meets a chunk as two matrices.  A cell that holds a third of all rows is
just many blocks.  The directory of cells that tasks hold is bounded by pivots
times annuli.

Defined cases: a row without id, with a null vector or with a null or non-finite
component takes no part; shorter vectors count as padded with zeros; repeated rows
count once, and of different vectors under one id the best score counts; scores
that pass 64 bits stop at its limits; an empty table has no results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .store import column, settle

#: Rows that pivots and annuli are taken from, chosen by a hash of their id.
SAMPLE, PIVOTS, ANNULI, ROUNDS = 4096, 48, 16, 6
#: Rows of a block, queries of a chunk, and cells looked at before the bounds apply.
BLOCK, CHUNK, FIRST = 2048, 512, 4
SLACK = 1e-9


@dataclass
class Directory:
    """Pivots, the edges of their annuli, and per cell the range of distances, the largest norm and the blocks."""

    pivots: np.ndarray
    edges: np.ndarray
    near: np.ndarray | None = None
    far: np.ndarray | None = None
    norm: np.ndarray | None = None
    blocks: np.ndarray | None = None

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        square = (vectors**2).sum(1)[:, None] + (self.pivots**2).sum(1) - 2 * vectors @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and distance from its pivot for each vector."""
        distance = self.distances(vectors)
        pivot = distance.argmin(1)
        distance = distance[np.arange(len(vectors)), pivot]
        annulus = (self.edges[pivot] < distance[:, None]).sum(1)
        return pivot * ANNULI + annulus, distance

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bound of the score of each query with anything in each cell; minus infinity for empty cells."""
        distance = np.repeat(self.distances(queries), ANNULI, axis=1)
        loose = SLACK * (distance + np.where(np.isfinite(self.far), self.far, 0)) + 1e-6
        away = np.maximum(0, np.maximum(self.near - distance, distance - self.far) - loose)
        return ((queries**2).sum(1)[:, None] * (1 + SLACK) + self.norm * (1 + SLACK) - away**2) / 2 + 1


def _matrix(column: pa.Array, width: int, scale: float) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, exact at any size of the components."""
    if np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * queries.shape[1] < 2**53:
        return (queries @ rows.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(queries) @ whole(rows).T, -(2**63), 2**63 - 1).astype(np.int64)


def _pivots(sample: np.ndarray) -> np.ndarray:
    """Centres of a few rounds of k-means; empty centres go."""
    centres = np.unique(sample[:PIVOTS], axis=0)
    for _ in range(ROUNDS):
        nearest = Directory(centres, np.empty(0)).distances(sample).argmin(1)
        centres = np.stack([sample[nearest == i].mean(0) for i in np.unique(nearest)])
    return centres


def _finite(values: Column) -> Column:
    return F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per query row (``is_query``, over a column ``id``): query_id, rank, vec_id, score.

    Components count as floor(scale * component).  Candidates are all rows but
    the query's own; ties go to the smaller id.
    """
    rows = vectors.select(column(id_col).cast("long").alias("id"), column(vector_col).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & _finite(F.col("vector")))
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    taken = rows.orderBy(F.xxhash64("id", F.lit(6)), "id").limit(SAMPLE).toArrow()
    if not taken.num_rows or not width:
        width, sample = max(width, 1), np.zeros((1, max(width, 1)))
    else:
        sample = _matrix(taken.column("vector").combine_chunks(), width, scale)
    pivots = _pivots(sample)
    found = Directory(pivots, np.zeros((len(pivots), ANNULI - 1)))
    distance = found.distances(sample)
    for i in range(len(pivots)):
        found.edges[i] = np.quantile(distance[distance.argmin(1) == i, i], np.arange(1, ANNULI) / ANNULI) if len(sample) else 0

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch.column(1), width, scale)
            cell, away = found.cells(matrix)
            packed = [r.tobytes() for r in matrix.astype("<f8")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(packed, pa.binary()), pa.array(cell, pa.int32()), pa.array(away), pa.array((matrix**2).sum(1))],
                ["id", "packed", "cell", "away", "norm"],
            )

    # repeated rows go before anything is counted or cut; the same vector has the same cell
    keyed = rows.mapInArrow(key, "id long, packed binary, cell int, away double, norm double")
    keyed = settle(keyed.dropDuplicates(["id", "packed"]), "keyed")
    queries = keyed.filter(is_query).select("id", "packed", F.floor(F.col("cell") / ANNULI).cast("int").alias("pivot"))
    size = len(pivots) * ANNULI
    found.near, found.far, found.norm = np.full(size, np.inf), np.full(size, -np.inf), np.full(size, -np.inf)
    found.blocks = np.zeros(size, np.int64)
    for r in keyed.groupBy("cell").agg(F.min("away"), F.max("away"), F.max("norm"), F.count(F.lit(1))).collect():  # a row per cell
        found.near[r[0]], found.far[r[0]], found.norm[r[0]], found.blocks[r[0]] = r[1], r[2], r[3], math.ceil(r[4] / BLOCK)
    asked = np.zeros(len(pivots), np.int64)
    for r in queries.groupBy("pivot").agg(F.count(F.lit(1))).collect():  # a row per pivot
        asked[r[0]] = math.ceil(r[1] / CHUNK)

    def slot(of: Column, slots: np.ndarray, seed: int) -> Column:
        many = F.array(*[F.lit(int(max(1, n))) for n in slots])
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.element_at(many, of + 1)).cast("int")

    blocks = keyed.withColumn("block", slot(F.col("cell"), found.blocks, 1)).select("cell", "block", "id", "packed")
    blocks = settle(blocks.groupBy("cell", "block").applyInArrow(_pack, "cell int, block int, ids binary, matrix binary"), "blocks")
    chunks = queries.withColumn("chunk", slot(F.col("pivot"), asked, 2)).select("pivot", "chunk", "id", "packed")
    chunks = settle(chunks.groupBy("pivot", "chunk").applyInArrow(_pack, "pivot int, chunk int, ids binary, matrix binary"), "chunks")

    first = settle(_met(chunks.withColumn("least", F.lit(None).cast("binary")), blocks, found, k), "first")
    floors = _ranked(first, k).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), "score")
    bounded = (
        queries.withColumn("chunk", slot(F.col("pivot"), asked, 2))
        .join(floors, "id", "left")
        .select("pivot", "chunk", "id", "packed", F.coalesce("score", F.lit(-(2**63))).alias("score"))
        .groupBy("pivot", "chunk")
        .applyInArrow(_pack, "pivot int, chunk int, ids binary, matrix binary, least binary")
    )
    rest = _met(settle(bounded, "chunks"), blocks, found, k)
    return _ranked(first.unionByName(rest), k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def _ranked(results: DataFrame, k: int) -> DataFrame:
    best = results.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _pack(group: pa.Table) -> pa.Table:
    """One row of the two key columns, all ids, all vectors, and the scores to reach if there are any."""
    group = group.sort_by([(group.column_names[2], "ascending"), (group.column_names[3], "ascending")])
    cells = [group.column(0)[:1], group.column(1)[:1]]
    names = [*group.column_names[:2], "ids", "matrix"]
    data = [group.column(2).to_numpy().astype("<i8").tobytes(), b"".join(group.column(3).to_pylist())]
    if group.num_columns > 4:
        data.append(group.column(4).to_numpy().astype("<i8").tobytes())
        names.append("least")
    return pa.table([*cells, *[pa.array([d], pa.binary()) for d in data]], names)


def _wanted(found: Directory, matrix: np.ndarray, least: np.ndarray | None) -> np.ndarray:
    """Which cells each query looks at: the most promising first, then all others that may reach ``least``."""
    bounds = found.bounds(matrix)
    best = np.argsort(-bounds, axis=1, kind="stable")[:, :FIRST]
    early = np.zeros(bounds.shape, bool)
    np.put_along_axis(early, best, True, axis=1)
    there = np.isfinite(found.norm)
    return early & there if least is None else ~early & there & (bounds >= least[:, None])


def _met(chunks: DataFrame, blocks: DataFrame, found: Directory, k: int) -> DataFrame:
    """The k best of every (chunk, block) pair that some query of the chunk looks at: query_id, id, score."""

    def read(ids: bytes, matrix: bytes, least: bytes | None) -> tuple:
        ids = np.frombuffer(ids, "<i8")
        matrix = np.frombuffer(matrix, "<f8").reshape(len(ids), -1)
        return ids, matrix, None if least is None else np.frombuffer(least, "<i8")

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, cell, block = [], [], []
            for i, row in enumerate(batch.select(["ids", "matrix", "least"]).to_pylist()):
                _, matrix, least = read(row["ids"], row["matrix"], row["least"])
                for c in np.flatnonzero(_wanted(found, matrix, least).any(0)).tolist():
                    for b in range(int(found.blocks[c])):
                        at.append(i)
                        cell.append(c)
                        block.append(b)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(cell, pa.int32()), pa.array(block, pa.int32())],
                ["pivot", "chunk", "cell", "block"],
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = batch.slice(row, 1).to_pylist()[0]
                asks, matrix, least = read(r["ids"], r["matrix"], r["least"])
                ids, vectors, _ = read(r["row_ids"], r["row_matrix"], None)
                on = np.flatnonzero(_wanted(found, matrix, least)[:, r["cell"]])
                scores = _scores(matrix[on], vectors)
                own = asks[on][:, None] == ids
                repeated = (ids[1:] == ids[:-1]).any()
                out = []
                for i in range(len(on)):
                    # ~x falls as x rises; ids of a block rise, so a stable sort settles ties
                    order = np.argsort(~scores[i], kind="stable")
                    order = order[~own[i][order]]
                    if repeated:  # different vectors under one id: the best of each, before the cut
                        order = order[np.sort(np.unique(ids[order], return_index=True)[1])]
                    order = order[:k]
                    out.append((np.full(len(order), asks[on[i]]), ids[order], scores[i][order]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "id", "score"])

    pairs = chunks.select("pivot", "chunk", "ids", "matrix", "least").mapInArrow(needs, "pivot int, chunk int, cell int, block int")
    met = (
        pairs.join(chunks, ["pivot", "chunk"])
        .join(blocks.select("cell", "block", F.col("ids").alias("row_ids"), F.col("matrix").alias("row_matrix")), ["cell", "block"])
        .select("cell", "ids", "matrix", "least", "row_ids", "row_matrix")
    )
    return met.mapInArrow(meet, "query_id long, id long, score long")
