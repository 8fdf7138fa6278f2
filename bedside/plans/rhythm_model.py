"""A rhythm classifier trained on annotated windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranges import label_windows
from ..session import durable

FEATURES = ("entropy", "variability")


@dataclass(frozen=True)
class RhythmModel:
    """Logistic regression on z-scored entropy and variability, as plain numbers.

    Called with the two z-scored columns it is the ``score`` of
    ``operators.features.rhythm_updates``.
    """

    centre: tuple[float, float]
    scale: tuple[float, float]
    weights: tuple[float, float]
    intercept: float
    threshold: float = 0.5

    def probability(self, z0: Column, z1: Column) -> Column:
        line = z0 * self.weights[0] + z1 * self.weights[1] + self.intercept
        return 1 / (1 + F.exp(-line))

    def __call__(self, z0: Column, z1: Column) -> Column:
        return self.probability(z0, z1) >= self.threshold

    def of_features(self) -> Column:
        """Probability from the columns entropy and variability themselves."""
        return self.probability(*_scored(self.centre, self.scale))


def _scored(centre, scale) -> list[Column]:
    return [(F.col(c) - m) / s for c, m, s in zip(FEATURES, centre, scale)]


def training_rows(
    features: DataFrame,
    intervals: DataFrame,
    keys=("session",),
    span: float | None = None,
    width: float = 300.0,
    no_entropy: float | None = None,
) -> DataFrame:
    """Updates a classifier has to decide, with the label of their window.

    ``features`` come from ``rhythm_features``; ``intervals`` are the annotated
    stretches of the rhythm (keys, begin, end).  A window with at least half of it
    inside one is labelled 1, any other 0; with ``span`` only its last so many seconds
    are held against them.  ``width`` is the bucket of the interval join.  Windows
    without an entropy are left out unless ``no_entropy`` stands for it.
    """
    if span is not None:
        features = features.withColumn("start", F.col("stop") - span)
    entropy = F.col("entropy") if no_entropy is None else F.coalesce("entropy", F.lit(float(no_entropy)))
    open_ = features.where(F.col("fixed").isNull()).withColumn("entropy", entropy)
    open_ = open_.where(F.col("entropy").isNotNull() & (F.col("stop") > F.col("start")))
    return label_windows(open_.drop("fixed"), intervals, keys, width)


def fit(rows: DataFrame, threshold: float = 0.5, penalty: float = 1e-3) -> RhythmModel | None:
    """Model of rows (entropy, variability, label); None where there are no rows.

    Means and deviations are those of the rows; the regression runs on Spark and
    only the weights reach the driver.  Rows of one label give a constant.
    """
    sums = [f(c).alias(f"{n}_{c}") for c in FEATURES for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    known = rows.select(*FEATURES, F.col("label").cast("double").alias("label"))
    m = known.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("rate"), *sums).first()
    if not m["n"]:
        return None
    centre = tuple(m[f"m_{c}"] for c in FEATURES)
    scale = tuple(m[f"s_{c}"] or 1.0 for c in FEATURES)
    if m["rate"] in (0.0, 1.0):
        return RhythmModel(centre, scale, (0.0, 0.0), float("inf") if m["rate"] else float("-inf"), threshold)
    z0, z1 = _scored(centre, scale)
    made = VectorAssembler(inputCols=["z0", "z1"], outputCol="features").transform(
        known.select(z0.alias("z0"), z1.alias("z1"), "label")
    )
    found = LogisticRegression(regParam=penalty, standardization=False).fit(made.select("features", "label"))
    return RhythmModel(centre, scale, tuple(float(w) for w in found.coefficients), float(found.intercept), threshold)


def out_of_fold(rows: DataFrame, folds: int = 5, keys=("session",), threshold: float = 0.5) -> DataFrame:
    """Rows with the probability a model gives them that never saw their session.

    The hash of the keys fixes the fold, so all windows of a session are in one.
    The probability is null where all other folds are empty.
    """
    rows = durable(rows.withColumn("fold", F.pmod(F.xxhash64(*keys), F.lit(folds)).cast("int")))
    probability = F.lit(None).cast("double")
    for fold in range(folds):
        model = fit(rows.where(F.col("fold") != fold), threshold)
        if model is not None:
            probability = F.when(F.col("fold") == fold, model.of_features()).otherwise(probability)
    scored = rows.withColumn("probability", probability)
    return scored.withColumn("decided", (F.col("probability") >= threshold).cast("int"))


def held_out_figures(scored: DataFrame) -> DataFrame:
    """One row: windows, share labelled 1, accuracy, sensitivity and specificity out of fold."""
    right = (F.col("decided") == F.col("label")).cast("int")
    return scored.agg(
        F.count(F.lit(1)).alias("windows"),
        F.avg("label").alias("rate"),
        F.avg(right).alias("accuracy"),
        F.avg(F.when(F.col("label") == 1, right)).alias("sensitivity"),
        F.avg(F.when(F.col("label") == 0, right)).alias("specificity"),
    )
