"""Joins with a dimension above the broadcast limit and a hot key."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.functions import skew
from basketry.operators import insights
from tests.test_plans import stored  # noqa: F401
from tests.toys import rows_of


@pytest.fixture(scope="module")
def lines(spark):
    """A third of the lines on one product, a sixth without one."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 != 1, F.col("id") % 5_000 + 100)
    return spark.range(0, 60_000, 1, 8).select(key.alias("productid"), F.col("id").alias("line"))


@pytest.fixture(scope="module")
def products(spark):
    known = spark.range(0, 4_000).select(F.col("id").alias("productid"), F.concat(F.lit("p"), "id").alias("name"))
    twice = spark.range(7, 9).select(F.col("id").alias("productid"), F.lit("again").alias("name"))
    return known.unionByName(twice)


def test_hot_keys_are_measured(lines):
    hot = skew.hot_keys(lines, "productid", 12)
    assert hot.parts == {7: 4} and hot.missing == 2
    assert skew.hot_keys(lines.where("false"), "productid").parts == {}


@pytest.mark.parametrize("limit", [0, 1 << 27])
def test_any_way_gives_the_rows_of_the_left_join(lines, products, limit):
    found = skew.join_dimension(lines, products, "productid", limit=limit, parts=16)
    wanted = lines.join(products, "productid", "left")
    assert found.columns == wanted.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, wanted.collect()))


def test_no_task_gets_a_hot_key_alone(spark, lines, products, monkeypatch):
    """Largest share of the joined lines in one task, without help by adaptive execution."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:

        def largest(joined):
            tasks = joined.groupBy(F.spark_partition_id().alias("task")).count()
            return tasks.agg(F.max("count") / F.sum("count")).first()[0]

        split = skew.join_dimension(lines, products, "productid", limit=0, parts=64)
        whole = lines.join(products, "productid", "left")
        assert largest(whole) > 0.4
        assert largest(split) < 0.12
    finally:
        for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("report", [insights.city_customers, insights.products_per_ticket])
def test_reports_are_the_same_beyond_the_limit(stored, report):  # noqa: F811
    from dataclasses import replace

    small, large = report(stored), report(replace(stored, broadcast_bytes=0))
    assert rows_of(large) == rows_of(small)


def test_the_joined_dataset_is_the_same_beyond_the_limit(stored):  # noqa: F811
    from dataclasses import replace

    assert sorted(rows_of(replace(stored, broadcast_bytes=0).dataset()), key=str) == sorted(rows_of(stored.dataset()), key=str)
