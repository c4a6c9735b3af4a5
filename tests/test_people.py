"""Distinct customers from bitmaps against the reports that count them one by one."""

import pytest
from pyspark.sql import functions as F

from basketry.functions.storage import Scratch
from basketry.operators import insights, people
from basketry.operators.dataset import WrittenDataset
from tests.toys import frame, rows_of

COLUMNS = "segmento string, city string, customerid long, gender string, age int"


@pytest.fixture(scope="module")
def source(spark):
    """Customers with several cities, ages, genders and segments; null and sparse ids."""
    rows = [
        (("best", "lost", "risk")[i % 3], (f"c{i % 7}", None)[i % 11 == 0], i * 7_919_771 % 1_000, ("M", "F", None, "U")[i % 4],
         (None, 15, 40, 80)[i % 5 % 4])
        for i in range(4_000)
    ]
    rows += [("best", None, None, None, None), ("lost", "c1", None, "M", 30), ("best", "c1", -(2**62), "F", 20)]
    return WrittenDataset(frame(spark, COLUMNS, *rows).repartition(5))


@pytest.mark.parametrize("strict", [False, True])
def test_both_reports_come_from_one_table(spark, source, strict):
    with Scratch(spark) as scratch:
        bitmaps = people.customer_bitmaps(source, scratch)
        assert rows_of(people.city_customers(bitmaps), "city", "segmento", "customer_count", "total_city") == rows_of(
            insights.city_customers(source), "city", "segmento", "customer_count", "total_city"
        )
        names = ("segmento", "age_range", "gender", "customer_count")
        assert rows_of(people.age_gender_bands(bitmaps, strict), *names) == rows_of(
            insights.age_gender_bands(source, strict), *names
        )
        everyone = people.distinct_customers(bitmaps, F.lit(1).alias("all")).first()["customer_count"]
        assert everyone == source.dataset.select("customerid").where("customerid is not null").distinct().count()


def test_no_customers(spark, source):
    with Scratch(spark) as scratch:
        none = people.customer_bitmaps(WrittenDataset(source.dataset.where("false")), scratch)
        assert people.city_customers(none).collect() == people.age_gender_bands(none).collect() == []


def test_bitmaps_are_full(spark):
    """Many customers of one kind in one city are a few rows, however their ids are spread."""
    wide = spark.range(100_000).select(
        F.lit("best").alias("segmento"), F.lit("c").alias("city"), (F.col("id") * 1_000_003).alias("customerid"),
        F.lit("F").alias("gender"), F.lit(30).alias("age"),
    )
    with Scratch(spark) as scratch:
        bitmaps = people.customer_bitmaps(WrittenDataset(wide), scratch)
        assert bitmaps.count() <= 8
        assert people.distinct_customers(bitmaps, "city").first()["customer_count"] == 100_000
