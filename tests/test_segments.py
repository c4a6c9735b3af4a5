import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.clustering import KMeans, KMeansModel

from basketry.functions.columns import nearest, segment_label, segment_name
from basketry.operators import segments
from basketry.operators.scoring import SCORES
from tests.toys import rows_of

SCORED = "customerid long, r_quartile int, f_quartile int, m_quartile int"


def _customers(spark, n, seed=1, parts=4):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        r = draw.choice([1, 1, 2, 3, 4])
        f = min(4, max(1, r + draw.choice([-1, 0, 0, 1])))
        m = min(4, max(1, f + draw.choice([-1, 0, 0, 1])))
        rows.append((i, r, f, m))
    return spark.createDataFrame(rows, SCORED).repartition(parts), rows


def _seeds_by_sorting(rows, clusters=6):
    size = math.ceil(len(rows) / clusters)
    medians = []
    for column in range(1, 4):
        ordered = sorted(row[column] for row in rows)
        chunks = [ordered[i : i + size] for i in range(0, len(ordered), size)]
        medians.append([chunk[math.ceil(len(chunk) / 2) - 1] for chunk in chunks])
    return list(zip(range(len(medians[0])), *medians))


@pytest.mark.parametrize("n", [1, 5, 6, 7, 11, 12, 25, 60, 61, 601])
def test_seeds_equal_sorting(spark, n):
    df, rows = _customers(spark, n, seed=n)
    assert rows_of(segments.seed_scores(df)) == _seeds_by_sorting(rows)


def test_no_customers_no_seeds(spark):
    assert segments.seed_scores(spark.createDataFrame([], SCORED)).count() == 0


def test_seeds_are_the_chunk_medians_of_approximate_percentiles(spark):
    df, rows = _customers(spark, 240)
    ordered = sorted(row[1] for row in rows)
    chunks = spark.createDataFrame([(i // 40, v) for i, v in enumerate(ordered)], "chunk int, v int")
    medians = rows_of(chunks.groupBy("chunk").agg(segments.F.percentile_approx("v", 0.5)))
    assert [row[:2] for row in rows_of(segments.seed_scores(df))] == medians


def test_standardised_columns(spark):
    df, rows = _customers(spark, 100)
    features, scaler = segments.standardise(df)
    values = np.array([row[1:] for row in rows], dtype=float)
    expected = (values - values.mean(axis=0)) / values.std(axis=0, ddof=1)
    found = [
        row[1] for row in rows_of(features.select("customerid", vector_to_array("scaled_features")))
    ]
    assert np.allclose(found, expected)
    again, same = segments.standardise(df, scaler)
    assert same is scaler
    assert rows_of(again, "customerid", "scaled_features") == rows_of(
        features, "customerid", "scaled_features"
    )


def test_constant_score_scales_to_zero(spark):
    df = spark.createDataFrame([(i, 2, 1 + i % 4, 1 + i % 3) for i in range(12)], SCORED)
    features, scaler = segments.standardise(df)
    assert {row[0][0] for row in features.select(vector_to_array("scaled_features")).collect()} == {0.0}
    seeds = segments.scaled_seeds(segments.seed_scores(df), scaler)
    assert {seed[0] for seed in seeds} == {0.0}


def test_too_few_customers(spark):
    df, _ = _customers(spark, 7)
    features, scaler = segments.standardise(df)
    seeds = segments.scaled_seeds(segments.seed_scores(df), scaler)
    with pytest.raises(ValueError, match="7 customers give 4 seeds for 6 clusters"):
        segments.fit_segments(features, seeds)


def _lloyd(points, weights, centroids, iterations=100, epsilon=1e-4):
    for _ in range(iterations):
        distances = ((points[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
        nearest_index = distances.round(9).argmin(axis=1)
        moved = centroids.copy()
        for k in range(len(centroids)):
            mine = nearest_index == k
            if mine.any():
                moved[k] = np.average(points[mine], axis=0, weights=weights[mine])
        converged = (((moved - centroids) ** 2).sum(axis=1) <= epsilon**2).all()
        centroids = moved
        if converged:
            break
    return centroids


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_kmeans_equals_weighted_lloyd(spark, seed):
    df, rows = _customers(spark, 3000, seed=seed)
    features, scaler = segments.standardise(df)
    seeds = segments.scaled_seeds(segments.seed_scores(df), scaler)
    fit = segments.fit_segments(features, seeds)

    triples, weights = np.unique([row[1:] for row in rows], axis=0, return_counts=True)
    points = (triples - np.array(scaler.mean)) / np.array(scaler.std)
    expected = _lloyd(points, weights, np.array(seeds))
    assert np.allclose(fit.centroids, expected, atol=1e-6)

    labelled = segments.assign(features, fit.centroids)
    values = (np.array([row[1:] for row in rows]) - np.array(scaler.mean)) / np.array(scaler.std)
    distances = ((values[:, None, :] - expected[None, :, :]) ** 2).sum(axis=2)
    two = np.sort(distances, axis=1)
    for row, label in enumerate(r[1] for r in rows_of(labelled, "customerid", "prediction")):
        if two[row, 1] - two[row, 0] > 1e-9:
            assert label == distances[row].argmin()


def test_every_customer_has_one_segment_and_a_null_customer_none(spark):
    df, rows = _customers(spark, 200)
    df = df.union(spark.createDataFrame([(None, 1, 1, 1)], SCORED))
    features, scaler = segments.standardise(df)
    seeds = segments.scaled_seeds(segments.seed_scores(df), scaler)
    labelled = segments.assign(features, seeds)
    assert rows_of(labelled, "customerid") == [(i,) for i in range(200)]
    assert labelled.where("segmento is null or prediction_label is null").count() == 0
    assert set(SCORES) < set(labelled.columns)


def test_tie_goes_to_the_lowest_index(spark):
    df = spark.createDataFrame([([0.0, 0.0, 0.0],), ([1.0, 1.0, 1.0],)], "p array<double>")
    centroids = [[1.0, 1.0, 1.0], [-1.0, -1.0, -1.0], [1.0, 1.0, 1.0]]
    assert [r[0] for r in df.select(nearest(segments.F.col("p"), centroids)).collect()] == [0, 0]


def test_coinciding_seeds_are_reported():
    fit = segments.Fit(model=None, seeds=[[0.0], [1.0], [1.0]])
    assert fit.coinciding_seeds == [(1, 2)]


def test_names_labels_and_fall_through(spark):
    df = spark.createDataFrame([(k,) for k in (0, 1, 2, 3, 4, 5, 7)], "p int")
    name = segment_name(segments.F.col("p"))
    assert [r[0] for r in df.orderBy("p").select(name).collect()] == [
        "best",
        "ocassional",
        "loyal",
        "promising",
        "risk",
        "lost",
        "7",
    ]
    label = segment_label(segments.F.col("p"), name)
    assert df.where("p = 0").select(label).first()[0] == "(0) best"


def test_centroid_frame(spark):
    points = [list(map(float, p)) for p in itertools.permutations((1, 2, 3))]
    assert rows_of(segments.centroid_frame(spark, points)) == [(k, *p) for k, p in enumerate(points)]


@pytest.mark.parametrize("seed", range(3))
def test_weighted_kmeans_equals_the_trainer_of_spark(spark, seed):
    rng = np.random.default_rng(seed)
    points = np.unique(rng.normal(size=(40, 3)).round(3), axis=0)
    weights = rng.integers(1, 20, len(points))
    seeds = points[:6].tolist()
    rows = spark.sparkContext.parallelize(np.repeat(points, weights, axis=0).tolist(), 2)
    theirs = KMeans.train(rows, 6, initialModel=KMeansModel(seeds)).clusterCenters
    ours = segments.weighted_kmeans(points, weights.astype(float), seeds)
    assert np.allclose(ours, np.array(theirs), atol=1e-9)


@pytest.mark.parametrize(("seed", "size", "parts"), [(0, 3, 1), (1, 2, 4), (2, 7, 32)])
def test_vector_kmeans_equals_the_trainer_of_spark(spark, seed, size, parts):
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(3_000, size)) + rng.integers(0, 4, (3_000, 1))
    seeds = points[:5].tolist()
    rows = [p.tolist() for p in points]
    theirs = KMeans.train(spark.sparkContext.parallelize(rows, 3), 5, initialModel=KMeansModel(seeds)).clusterCenters
    odd = [None, [], [1.0] * (size + 1), [None] * size, [float("nan")] * size]
    frame = spark.createDataFrame([(p,) for p in rows + odd], "point array<double>").repartition(6).cache()
    assert np.allclose(segments.vector_kmeans(frame, seeds, parts=parts), np.array(theirs), atol=1e-9)


def test_fit_takes_vectors_of_any_number(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(2_000, 3))
    points[:1_200] = points[0]  # one place holds most of the rows
    features = spark.createDataFrame([(p.tolist(),) for p in points], "p array<double>").repartition(5)
    features = features.select(array_to_vector("p").alias("scaled_features"))
    seeds = points[[0, 1300, 1400, 1500, 1600, 1700]].tolist()
    wanted = _lloyd(points, np.ones(len(points)), np.array(seeds))
    assert np.allclose(segments.fit_segments(features, seeds).centroids, wanted, atol=1e-9)


def test_centres_without_points_and_empty_tables_stay(spark):
    one = spark.createDataFrame([([1.0, 1.0],), ([3.0, 3.0],)], "point array<double>")
    assert segments.vector_kmeans(one, [[2.0, 2.0], [90.0, 90.0]]) == [[2.0, 2.0], [90.0, 90.0]]
    assert segments.vector_kmeans(one.where("false"), [[2.0], [5.0]]) == [[2.0], [5.0]]


def test_sums_of_a_centre_leave_a_task_as_one_row(spark):
    points = spark.range(0, 200_000, 1, 16).selectExpr("array(double(id % 7), 0.5D) AS point")
    sums = segments._center_sums(points, [[0.0, 0.0], [100.0, 0.0]], 2, 4)
    assert [(r["center"], r["n"], r["x1"]) for r in sums.collect()] == [(0, 200_000, 100_000.0)]
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "ArrowEval" not in plan


def test_rounds_call_no_function_for_each_coordinate(spark, monkeypatch):
    plans = []
    sums = segments._center_sums

    def noted(points, *given):
        found = sums(points, *given)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(segments, "_center_sums", noted)
    points = spark.range(100).selectExpr("array(double(id), 0.5D) AS point")
    segments.vector_kmeans(points, [[0.0, 0.0], [100.0, 0.0]])
    assert plans and "lambda" not in "".join(plans)
