import math
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from basketry.functions import quantiles
from basketry.functions.quantiles import exact_quantiles, exact_quantiles_of

PROBABILITIES = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]


def _frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-20, 20).map(float), st.floats(-1e9, 1e9)), max_size=60))
def test_equals_exact_approx_quantile(spark, values):
    df = _frame(spark, values).cache()
    expected = df.approxQuantile("x", PROBABILITIES, 0.0)
    assert exact_quantiles(df, ["x"], PROBABILITIES)["x"] == expected
    df.unpersist()


def test_large_column_with_ties(spark):
    draw = random.Random(3)
    values = [float(int(draw.expovariate(0.002))) for _ in range(50_000)]
    df = _frame(spark, values).repartition(8).cache()
    found = exact_quantiles(df, ["x"], PROBABILITIES)["x"]
    assert found == df.approxQuantile("x", PROBABILITIES, 0.0)


@pytest.mark.parametrize("few", [0, 40, 1 << 16])
def test_ranges_are_cut_until_the_rank_is_found(spark, monkeypatch, few):
    draw = random.Random(4)
    values = [draw.choice((draw.random(), draw.gauss(0, 1e-300), draw.gauss(0, 1e300), -0.0, 5.0)) for _ in range(20_000)]
    values += [math.inf, -math.inf, 5e-324, -5e-324, 1.7e308, -1.7e308]
    df = _frame(spark, values).repartition(4).cache()
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "RANGES", 16 if few < 100 else 1024)
    ordered, wanted = sorted(values), [0.0, 0.001, 0.1, 0.4, 0.5, 0.7, 0.9, 0.999, 1.0]
    found = exact_quantiles(df, ["x"], wanted)["x"]
    assert found == [ordered[max(1, math.ceil(p * len(ordered))) - 1] for p in wanted]


@pytest.mark.parametrize("kind", ["first", "later"])
def test_counters_do_not_grow_with_partitions_or_rows(spark, kind):
    """What the last task and the driver get is one row for each range."""
    target = quantiles._Target("x", 1, 1, 0.0, 1.0)
    sizes = set()
    for rows, parts in ((40_000, 4), (40_000, 64), (400_000, 64)):
        numbers = spark.range(0, rows, 1, parts).select(((F.col("id") * 7919 % 40_000) / 40_000).alias("x"))
        counts = quantiles.magnitudes(numbers, ["x"]) if kind == "first" else quantiles.ranges_of(numbers, [target])
        plan = counts._jdf.queryExecution().toString()
        assert "SinglePartition" not in plan and "Window" not in plan
        assert sum(r["rows"] for r in counts.collect()) == rows
        sizes.add(counts.count())
    assert len(sizes) == 1 and sizes.pop() <= quantiles.RANGES


def test_several_columns_with_their_own_probabilities(spark):
    df = spark.createDataFrame([(i, float(-i), None) for i in range(1, 101)], "a int, b double, c long")
    assert exact_quantiles_of(df, {"a": [0.5], "b": [0.25, 0.75], "c": [0.5]}) == {
        "a": [50.0],
        "b": [-76.0, -26.0],
        "c": [],
    }


def test_nan_and_null_are_skipped(spark):
    df = _frame(spark, [None, float("nan"), 1.0, 2.0, 3.0])
    assert exact_quantiles(df, ["x"], [0.5, 1.0])["x"] == [2.0, 3.0]


@pytest.mark.parametrize("n", [1, 2, 6, 7, 99, 100, 101])
def test_small_sizes(spark, n):
    df = _frame(spark, [float(v) for v in range(n)])
    assert exact_quantiles(df, ["x"], PROBABILITIES)["x"] == df.approxQuantile("x", PROBABILITIES, 0.0)
