"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal updates.

A text's tokens are words and runs of other marks.  Its features are hashed
unigrams and bigrams of the lower-cased tokens and n-grams of their shapes (case,
digits, the marks themselves, and whether a word repeats the one before), each
with the logarithm of its count, the vector scaled to length one.  Every shard of
a bounded sample of labelled rows is trained on by follow-the-regularised-leader
updates in its own task; the weights are the averages over shards.  A score is the
sparse dot product of weights and features, through the logistic function.

Defined cases: null text is empty; an empty text has just the intercept; a label
given several times for one id counts once, the lowest; rows without id or label
are not learned from; without any labelled row every score is 0.5.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import column

TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Features are hashed to so many weights; weight 0 is the intercept.
DIMENSIONS = 1 << 18
#: At most so many labelled rows are learned from, chosen by a hash of their id, in so many shards.
SAMPLE, SHARDS, EPOCHS = 8000, 2, 10
#: FTRL-proximal: learning rate, its smoothing, and both penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3
REMEMBERED, LONGEST = 150_000, 40
MIX = np.uint64(0x9E3779B97F4A7C15)


class _Tokens(dict):
    """Hash of each lower-cased token and the number of its shape, for as many as fit."""

    def __missing__(self, token: str) -> tuple[int, int]:
        found = xxhash.xxh3_64_intdigest(token.lower()), _shape(token)
        if len(token) <= LONGEST:
            if len(self) > REMEMBERED:
                self.clear()
            self[token] = found
        return found


def _shape(token: str) -> int:
    if not (token[0].isalnum() or token[0] == "_"):
        return xxhash.xxh3_64_intdigest(token)
    if token.isdigit():
        return 1
    if not token.isalpha():
        return 2
    if token.islower():
        return 3
    if token.isupper():
        return 4 if len(token) > 1 else 5
    return 6 if token[1:].islower() else 7


_TOKENS = _Tokens()


def _mixed(*parts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out = (out ^ part) * MIX
        out ^= out >> np.uint64(29)
    return out


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's features, places rising."""
    found = TOKEN.findall(text) if text else []
    pairs = np.array([_TOKENS[t] for t in found], np.uint64).reshape(-1, 2)
    words, shapes = pairs[:, 0], pairs[:, 1].copy()
    shapes[1:][words[1:] == words[:-1]] ^= np.uint64(1 << 40)
    hashed = [_mixed(words), _mixed(shapes, np.full(len(shapes), 5, np.uint64))]
    if len(words) > 1:
        hashed.append(_mixed(words[:-1], words[1:]))
        hashed.append(_mixed(shapes[:-1], shapes[1:], np.full(len(shapes) - 1, 7, np.uint64)))
    if len(words) > 2:
        hashed.append(_mixed(shapes[:-2], shapes[1:-1], shapes[2:], np.full(len(shapes) - 2, 9, np.uint64)))
    spread = (np.concatenate(hashed) >> np.uint64(20)) % np.uint64(DIMENSIONS - 1) + np.uint64(1)
    place, count = np.unique(spread.astype(np.int64), return_counts=True)
    value = np.log1p(count)
    if len(value):
        value /= np.sqrt((value * value).sum())
    return np.r_[0, place], np.r_[1.0, value]


@dataclass
class QualityModel:
    weights: np.ndarray
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def score(self, text: str | None) -> float:
        place, value = features(text)
        return float(1 / (1 + np.exp(-np.dot(self.weights[place], value))))


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss."""

    def __init__(self):
        self.z, self.n = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)

    def weights(self, place: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[place], self.n[place]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, place: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(place)
        gradient = (1 / (1 + np.exp(-np.dot(w, value))) - label) * value
        squared = gradient * gradient
        sigma = (np.sqrt(self.n[place] + squared) - np.sqrt(self.n[place])) / ALPHA
        self.z[place] += gradient - sigma * w
        self.n[place] += squared


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> QualityModel:
    """Learn ``label_col`` (0 or 1) of ``labels`` from the texts of ``docs``."""
    chosen = (
        labels.select(column(id_col).alias("id"), column(label_col).cast("double").alias("label"))
        .filter("id is not null and label is not null")
        .groupBy("id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("id", F.lit(3)), "id")
        .limit(sample)
    )
    # at most ``sample`` rows of two numbers: their size is bounded
    rows = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([p for p, _ in found], pa.list_(pa.int32())),
                    pa.array([v for _, v in found], pa.list_(pa.float64())),
                ],
                ["id", "label", "place", "value"],
            )

    def train(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["id", "label"], ignore_index=True)
        places = [np.asarray(x, np.int64) for x in shard["place"]]
        learner, order = Ftrl(), np.random.default_rng(3)
        for _ in range(EPOCHS):
            for i in order.permutation(len(shard)):
                learner.update(places[i], np.asarray(shard["value"].iat[i]), shard["label"].iat[i])
        weights = learner.weights(slice(None))
        at = np.flatnonzero(weights)
        return pd.DataFrame({"place": at.astype(np.int32), "weight": weights[at]})

    kind = docs.select(column(id_col)).dtypes[0][1]
    shards = (
        rows.select("id", "text", "label")
        .mapInArrow(vectors, f"id {kind}, label double, place array<int>, value array<double>")
        .groupBy(F.pmod(F.xxhash64("id", F.lit(4)), F.lit(SHARDS)).alias("shard"))
    )
    found = shards.applyInPandas(train, "place int, weight double").groupBy("place").agg((F.sum("weight") / SHARDS).alias("weight"))
    found = found.toPandas()  # one row per weight at most
    weights = np.zeros(DIMENSIONS)
    weights[found["place"].to_numpy()] = found["weight"].to_numpy()
    return QualityModel(weights)


def scored(model: QualityModel, text: Column) -> Column:
    """Probability of label 1 for a text column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t if isinstance(t, str) else None) for t in texts], dtype="float64")

    return score(text)
