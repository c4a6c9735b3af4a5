"""Exact numbers of distinct customers for several groupings from one table of bitmaps.

Every customer gets a number. Numbers run on within a partition of customers that are
ordered by segment, age band and gender, so the customers of one bitmap, 32,768 numbers
in a row, mostly share these, and bitmaps are full instead of many. One pass over the joined
relation sets the bits by segment, city, age band and gender; any coarser grouping is the
union of its bitmaps, bucket by bucket, which counts a customer once however many cities
or lines they have. Unions and counts combine on the map side and no customer is shuffled again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions.columns import age_band
from basketry.functions.storage import Scratch
from basketry.operators.insights import Source

_HOME = ("segmento", "age_range", "gender")


def numbered_customers(people: DataFrame, scratch: Scratch) -> DataFrame:
    """``customerid`` and a ``number`` of its own for each customer, as a written table.

    A number follows from the partition and the place in it, so the table is written before
    it is used: whoever reads it sees the same numbers."""
    home = F.min(F.struct(*_HOME)).alias("home")
    customers = people.where("customerid is not null").groupBy("customerid").agg(home)
    order = ("home", F.xxhash64("customerid"))  # a home with most of the customers is dealt too
    ranged = customers.repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch.table(ranged.select("customerid", F.monotonically_increasing_id().alias("number")), "numbers")


def customer_bitmaps(source: Source, scratch: Scratch) -> DataFrame:
    """``segmento``, ``city``, ``age_range``, ``gender``, ``known_age``, ``bucket``, ``customers``.

    One row for each group and bucket of 32,768 numbers, with a bit for each customer of the
    group. A customer with several ages, genders or cities is in each of the groups. A null
    customer sets no bit; a group of theirs alone has an empty bitmap and counts 0."""
    banded = [age_band(F.col("age")).alias("age_range"), "gender", F.col("age").isNotNull().alias("known_age")]
    rows = source.distinct_rows("segmento", "city", "customerid", "gender", "age")
    people = scratch.table(rows.select("segmento", "city", "customerid", *banded).distinct(), "people")
    numbers = numbered_customers(people, scratch)
    bits = (
        people.join(numbers, "customerid", "left")
        .groupBy("segmento", "city", *_HOME[1:], "known_age", F.bitmap_bucket_number("number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("customers"))
    )
    return scratch.table(bits, "bitmaps")


def distinct_customers(bitmaps: DataFrame, *groups: str | Column) -> DataFrame:
    """``customer_count`` of each group, from the union of its bitmaps."""
    union = bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("customers").alias("customers"))
    names = [c for c in union.columns if c not in ("bucket", "customers")]
    return union.groupBy(*names).agg(F.sum(F.bitmap_count("customers")).alias("customer_count"))


def city_customers(bitmaps: DataFrame) -> DataFrame:
    """:func:`basketry.operators.insights.city_customers` from bitmaps."""
    total = F.sum("customer_count").over(Window.partitionBy("city"))
    return (
        distinct_customers(bitmaps.where("city is not null"), "city", "segmento")
        .withColumn("total_city", total)
        .orderBy(F.desc("total_city"))
    )


def age_gender_bands(bitmaps: DataFrame, strict_age: bool = False) -> DataFrame:
    """:func:`basketry.operators.insights.age_gender_bands` from the same bitmaps."""
    aged = F.col("known_age")
    men = (F.col("gender") == "M") & aged if strict_age else F.col("gender") == "M"
    kept = bitmaps.where(((F.col("gender") == "F") & aged) | men)
    return distinct_customers(kept, "segmento", "age_range", "gender").orderBy(F.desc("segmento"))
