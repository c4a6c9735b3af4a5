"""Standardised scores, seeds, K-Means and named segments."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.clustering import KMeansModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.functions.columns import SEGMENTS, TIE_DECIMALS, nearest, segment_label, segment_name
from basketry.functions.storage import Scratch
from basketry.operators.scoring import SCORES
from basketry.schemas import CENTROIDS

N_CLUSTERS = len(SEGMENTS)
SCORE_LEVELS = 4
ITERATIONS = 100
EPSILON = 1e-4
PARTS = 32  # groups in which the sums of one centre meet first

Points = list[list[float]]


def assemble(scored: DataFrame) -> DataFrame:
    """Adds the three scores as the vector ``features``."""
    assembler = VectorAssembler(inputCols=list(SCORES), outputCol="features", handleInvalid="skip")
    return assembler.transform(scored)


METRIC_VECTOR = ("recency", "frequency", "monetary")


def assemble_metrics(rfm_table: DataFrame) -> DataFrame:
    """Adds the three unscored metrics as the vector ``features``; a row with a null one goes."""
    assembler = VectorAssembler(inputCols=list(METRIC_VECTOR), outputCol="features", handleInvalid="skip")
    return assembler.transform(rfm_table)


def fit_scaler(assembled: DataFrame) -> StandardScalerModel:
    scaler = StandardScaler(
        inputCol="features", outputCol="scaled_features", withMean=True, withStd=True
    )
    return scaler.fit(assembled)


def standardise(
    scored: DataFrame, scaler: StandardScalerModel | None = None
) -> tuple[DataFrame, StandardScalerModel]:
    """Adds ``features`` and ``scaled_features``; the scaler is fitted here unless given."""
    assembled = assemble(scored)
    scaler = scaler or fit_scaler(assembled)
    return scaler.transform(assembled), scaler


def seed_scores(scored: DataFrame, clusters: int = N_CLUSTERS) -> DataFrame:
    """Seeds on the score scale: medians of equal-count chunks of each sorted score.

    A score takes four values, so how many customers lie at or below each value tells
    the score at any sorted position. One aggregate gives these counts; no customer is
    sorted or numbered. The median of an even chunk is the lower one.
    """
    counts = scored.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.count_if(F.col(s) <= level).alias(f"{s}_{level}")
            for s in SCORES
            for level in range(1, SCORE_LEVELS)
        ],
    ).where("n > 0")
    chunks = (
        counts.withColumn("size", F.ceil(F.col("n") / clusters))
        .withColumn("last", F.ceil(F.col("n") / F.col("size")) - 1)
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
        .withColumn("start", F.col("chunk") * F.col("size"))
        .withColumn(
            "position",
            F.col("start") + F.ceil(F.least("size", F.col("n") - F.col("start")) / 2),
        )
    )

    def at_position(s: str) -> Column:
        passed = (
            (F.col("position") > F.col(f"{s}_{level}")).cast("int") for level in range(1, SCORE_LEVELS)
        )
        return sum(passed, F.lit(1)).alias(s)

    return chunks.select(F.col("chunk").cast("int").alias("chunk"), *map(at_position, SCORES))


def scaled_seeds(seeds: DataFrame, scaler: StandardScalerModel) -> Points:
    """Seeds in chunk order on the standardised scale. Scaling keeps order and medians."""
    factors = [1 / std if std else 0.0 for std in scaler.std]
    return [
        [float((row[s] - mean) * factor) for s, mean, factor in zip(SCORES, scaler.mean, factors)]
        for row in seeds.orderBy("chunk").collect()
    ]


@dataclass(frozen=True)
class Fit:
    """Result of a K-Means fit, with the seeds it started from."""

    model: KMeansModel
    seeds: Points

    @property
    def centroids(self) -> Points:
        return [[float(x) for x in center] for center in self.model.clusterCenters]

    @property
    def coinciding_seeds(self) -> list[tuple[int, int]]:
        """Pairs of seeds with the same place; a tie between them goes to the first."""
        return [
            (i, j)
            for i in range(len(self.seeds))
            for j in range(i + 1, len(self.seeds))
            if self.seeds[i] == self.seeds[j]
        ]


def fit_segments(features: DataFrame, seeds: Points, clusters: int = N_CLUSTERS) -> Fit:
    """K-Means on ``scaled_features`` from the given seeds.

    Scores have few levels, so all customers lie on at most ``SCORE_LEVELS`` cubed points.
    One aggregate weights these; the iterations run on them alone. Other vectors, of any
    number and size, go through :func:`vector_kmeans`.
    """
    if len(seeds) != clusters:
        raise ValueError(
            f"{features.count()} customers give {len(seeds)} seeds for {clusters} clusters"
        )
    most = SCORE_LEVELS ** len(SCORES)
    point = vector_to_array("scaled_features")
    if len(seeds[0]) == len(SCORES):
        axes = [F.get(point, i).alias(s) for i, s in enumerate(SCORES)]
        weighted = features.select(*axes).groupBy(*SCORES).count().limit(most + 1).collect()
        if len(weighted) <= most:
            weighted.sort()
            points = np.array([row[:-1] for row in weighted], dtype=float).reshape(-1, len(SCORES))
            weights = np.array([row[-1] for row in weighted], dtype=float)
            return Fit(KMeansModel(weighted_kmeans(points, weights, seeds).tolist()), seeds)
    with Scratch(features.sparkSession) as scratch:
        points_table = scratch.table(features.select(point.alias("point")), "points")
        return Fit(KMeansModel(vector_kmeans(points_table, seeds)), seeds)


def vector_kmeans(
    points: DataFrame,
    seeds: Points,
    iterations: int = ITERATIONS,
    epsilon: float = EPSILON,
    parts: int = PARTS,
) -> Points:
    """Centres of K-Means over the array column ``point``, by rounds on the whole table.

    A round assigns every point to its nearest centre and adds up coordinates and numbers
    of points by centre: partial sums leave a task as one row per centre, meet in ``parts``
    groups of each centre, and one row per centre reaches the driver. ``points`` is read
    once a round, so it should be a written table. Rounds end as those of
    :func:`weighted_kmeans`. A point with a null or NaN coordinate, or of another size, takes no part.
    """
    size = len(seeds[0])
    # One comparison per coordinate: a function over the array would be called for every point and round.
    axes = [F.get("point", i) for i in range(size)]
    usable = reduce(and_, [a.isNotNull() & ~F.isnan(a) for a in axes], F.size("point") == size)
    points = points.where(F.col("point").isNotNull() & usable)
    centers = [[float(x) for x in seed] for seed in seeds]
    for _ in range(iterations):
        sums = _center_sums(points, centers, size, parts).collect()
        moved = list(centers)
        for row in sums:
            moved[row["center"]] = [row[f"x{i}"] / row["n"] for i in range(size)]
        shifts = [sum((a - b) ** 2 for a, b in zip(old, new)) for old, new in zip(centers, moved)]
        centers = moved
        if all(shift <= epsilon**2 for shift in shifts):
            break
    return centers


def _center_sums(points: DataFrame, centers: Points, size: int, parts: int) -> DataFrame:
    """``center``, ``n`` and the sum of each coordinate of the centre's points."""
    names = [f"x{i}" for i in range(size)]
    axes = [F.get("point", i).alias(name) for i, name in enumerate(names)]
    # A centre with most of the points still meets in several tasks.
    part = (F.spark_partition_id() % parts).alias("part")
    placed = points.select(nearest(F.col("point"), centers, decimals=None).alias("center"), part, *axes)
    sums = [F.sum(name).alias(name) for name in names]
    partial = placed.groupBy("center", "part").agg(F.count(F.lit(1)).alias("n"), *sums)
    return partial.groupBy("center").agg(F.sum("n").alias("n"), *sums)


def weighted_kmeans(points: np.ndarray, weights: np.ndarray, seeds: Points) -> np.ndarray:
    """Centres after rounds of assignment and weighted means.

    Ends when no centre moves by more than ``EPSILON``, or after ``ITERATIONS`` rounds. A
    centre without points stays where it is; the lowest index wins a tie.
    """
    centers = np.array(seeds, dtype=float)
    for _ in range(ITERATIONS):
        distances = ((points[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
        own = distances.argmin(axis=1)[:, None] == np.arange(len(centers))
        mass = own * weights[:, None]
        total = mass.sum(axis=0)
        means = mass.T @ points / np.where(total > 0, total, 1)[:, None]
        moved = np.where((total > 0)[:, None], means, centers)
        done = (((moved - centers) ** 2).sum(axis=1) <= EPSILON**2).all()
        centers = moved
        if done:
            break
    return centers


def assign(
    features: DataFrame, centroids: Sequence[Sequence[float]], decimals: int | None = TIE_DECIMALS
) -> DataFrame:
    """Adds ``prediction``, ``segmento`` and ``prediction_label``.

    A row without a customer is not labelled and leaves the table. Scores lie on a grid
    where distances tie, so these are compared to ``decimals``; None compares them as they are.
    """
    prediction = nearest(vector_to_array("scaled_features"), centroids, decimals)
    return (
        features.where(F.col("customerid").isNotNull())
        .withColumn("prediction", prediction)
        .withColumn("segmento", segment_name(F.col("prediction")))
        .withColumn("prediction_label", segment_label(F.col("prediction"), F.col("segmento")))
    )


def centroid_frame(spark: SparkSession, centroids: Points) -> DataFrame:
    return spark.createDataFrame([(k, *center) for k, center in enumerate(centroids)], CENTROIDS)
