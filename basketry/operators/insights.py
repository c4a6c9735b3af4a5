"""The fifteen report tables.

The first three read the predictions. The others take a source with ``rows`` and
``distinct_rows`` (:mod:`basketry.operators.dataset`): the base tables for a single
report, or the written dataset for many. Each distinct projection states the grain
that a report counts. ``*_fraction`` columns run from 0 to 1, ``*_pct`` from 0 to 100.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from basketry.functions.columns import UNKNOWN_GENDER, age_band, gender_name, ratio
from basketry.operators.dataset import RetailTables, WrittenDataset

Source = RetailTables | WrittenDataset

# What the reports on people and the reports on lines read of the joined relation.
PEOPLE_COLUMNS = ("segmento", "customerid", "age", "gender")
LINE_COLUMNS = (
    "segmento",
    "customerid",
    "ticketid",
    "productid",
    "originalamount",
    "extendedamount",
    "quantity",
    "city",
    "merchandisefamily",
    "vatdescription",
    "article",
    "healthy",
    "unhealthy",
)

TOP_FAMILIES = 10
TOP_ARTICLES = 5


def spend_share(predictions: DataFrame) -> DataFrame:
    """Amount spent by segment and its fraction of the whole; summed as exact decimals."""
    paid = F.col("monetary").cast("decimal(38,10)")
    return (
        predictions.groupBy("segmento")
        .agg(F.sum(paid).alias("spend"))
        .select(
            "segmento",
            F.col("spend").cast("double").alias("spend_by_segment"),
            F.sum("spend").over(_all_segments()).cast("double").alias("total_spend"),
        )
        .withColumn("spend_fraction", ratio(F.col("spend_by_segment"), F.col("total_spend")))
        .orderBy("segmento")
    )


def customer_share(predictions: DataFrame) -> DataFrame:
    """Customers by segment and their fraction of all prediction rows."""
    return (
        predictions.groupBy("segmento")
        .agg(F.count("customerid").alias("customer_count"), F.count(F.lit(1)).alias("rows"))
        .select(
            "segmento",
            "customer_count",
            F.sum("rows").over(_all_segments()).alias("total_customer_count"),
        )
        .withColumn(
            "customer_fraction", ratio(F.col("customer_count"), F.col("total_customer_count"))
        )
        .orderBy("segmento")
    )


def rfm_means(predictions: DataFrame) -> DataFrame:
    """Mean recency, frequency and monetary value by segment."""
    return (
        predictions.groupBy("segmento")
        .agg(
            F.avg("frequency").alias("frequency_avg"),
            F.avg("monetary").alias("monetary_avg"),
            F.avg("recency").alias("recency_avg"),
        )
        .orderBy("segmento")
    )


def age_mean(source: Source) -> DataFrame:
    """Mean age of the customers of each segment."""
    customers = source.distinct_rows("segmento", "customerid", "age").where("age is not null")
    return customers.groupBy("segmento").agg(F.avg("age").alias("age_avg"))


def gender_share(source: Source) -> DataFrame:
    """Customers of known gender by segment, and their fraction of the segment's."""
    return (
        source.distinct_rows("segmento", "customerid", "gender")
        .select("segmento", "customerid", gender_name(F.col("gender")).alias("new_gender"))
        .where(F.col("new_gender") != UNKNOWN_GENDER)
        .groupBy("segmento", "new_gender")
        .agg(F.count("customerid").alias("gender_count"))
        .withColumn("total_gender_count", F.sum("gender_count").over(_segment()))
        .withColumn("gender_fraction", ratio(F.col("gender_count"), F.col("total_gender_count")))
        .orderBy("segmento")
    )


def family_counts(source: Source) -> DataFrame:
    """Lines sold of each product family by segment."""
    return (
        source.sold("merchandisefamily")
        .where("merchandisefamily is not null")
        .groupBy("segmento", "merchandisefamily")
        .agg(F.sum(F.when(F.col("productid").isNotNull(), F.col("lines")).otherwise(0)).alias("product_count"))
    )


def top_families(counts: DataFrame, n: int = TOP_FAMILIES) -> DataFrame:
    """Families with rank up to ``n`` from :func:`family_counts`; ties share a rank."""
    return _ranked(counts, F.desc("product_count"), n)


def last_families(counts: DataFrame, n: int = TOP_FAMILIES) -> DataFrame:
    """The same from the smallest count upwards."""
    return _ranked(counts, F.asc("product_count"), n)


def products_per_ticket(source: Source) -> DataFrame:
    """Mean over the customers of a segment of their product lines per ticket."""
    return (
        source.distinct_rows("segmento", "customerid", "ticketid", "productid", "quantity")
        .groupBy("segmento", "customerid")
        .agg(
            ratio(F.count("productid"), F.count_distinct("ticketid")).alias("avg_purchase_count")
        )
        .groupBy("segmento")
        .agg(F.avg("avg_purchase_count").alias("avg_purchase_count"))
    )


def vat_share(source: Source) -> DataFrame:
    """Percentage of each VAT class among the products bought by a segment."""
    rows = _bought(source, "vatdescription").where("vatdescription is not null")
    return _percentages(rows, "vatdescription", products=F.sum("bought"))


def health_share(source: Source) -> DataFrame:
    """Percentage of each healthy and unhealthy mark among the products bought."""
    rows = _bought(source, "healthy", "unhealthy").where("healthy is not null")
    return _percentages(rows, "healthy", "unhealthy", products=F.sum("bought"))


def discount_share(source: Source) -> DataFrame:
    """Percentage of products of each ticket that cost less than their list amount."""
    saved = F.sum("originalamount") - F.sum("extendedamount")
    products = (
        source.distinct_rows(
            "segmento", "customerid", "ticketid", "productid", "originalamount", "extendedamount"
        )
        .where("originalamount is not null")
        .groupBy("segmento", "ticketid", "productid")
        .agg(F.when(saved > 0, F.lit("YES")).otherwise(F.lit("NO")).alias("discount"))
    )
    return _percentages(products, "discount")


def total_spend_millions(source: Source) -> DataFrame:
    """Amount paid over all rows, in millions."""
    return (
        source.sold()
        .agg((F.sum("paid").cast("double") / 1_000_000).alias("total_in_millions"))
    )


def top_articles(source: Source, n: int = TOP_ARTICLES) -> DataFrame:
    """Articles with rank up to ``n`` by lines sold in a segment; ties share a rank."""
    counts = (
        source.sold("article")
        .where("article is not null")
        .groupBy("segmento", "article")
        .agg(F.sum("lines").alias("product_count"))
    )
    return _ranked(counts, F.desc("product_count"), n)


def city_customers(source: Source) -> DataFrame:
    """Customers by city and segment, with the sum over the segments of the city."""
    return (
        source.distinct_rows("segmento", "city", "customerid")
        .where("city is not null")
        .groupBy("city", "segmento")
        .agg(F.count("customerid").alias("customer_count"))
        .withColumn("total_city", F.sum("customer_count").over(Window.partitionBy("city")))
        .orderBy(F.desc("total_city"))
    )


def age_gender_bands(source: Source, strict_age: bool = False) -> DataFrame:
    """Customers by segment, age band and gender.

    Gender F without an age is left out. Gender M without an age counts in the last
    band, unless ``strict_age`` is set.
    """
    known_age = F.col("age").isNotNull()
    kept = (F.col("gender") == "F") & known_age
    kept |= (F.col("gender") == "M") & known_age if strict_age else F.col("gender") == "M"
    return (
        source.distinct_rows("segmento", "customerid", "gender", "age")
        .where(kept)
        .groupBy("segmento", age_band(F.col("age")).alias("age_range"), "gender")
        .agg(F.count_distinct("customerid").alias("customer_count"))
        .orderBy(F.desc("segmento"))
    )


def _segment() -> WindowSpec:
    return Window.partitionBy("segmento")


def _all_segments() -> WindowSpec:
    """For tables that have one row per segment."""
    return Window.partitionBy(F.lit(0))


def _ranked(counts: DataFrame, order: Column, n: int) -> DataFrame:
    """Rows whose rank in their segment is at most ``n``.

    The rank filter also limits each map task to its own first ``n`` ranks.
    """
    rank = F.rank().over(_segment().orderBy(order)).cast("long")
    return counts.withColumn("rank", rank).where(F.col("rank") <= n)


def _bought(source: Source, *attributes: str) -> DataFrame:
    """The baskets of a source with the distinct values of product ``attributes``."""
    return source.baskets().join(source.attributes(*attributes), "productid")


def _percentages(rows: DataFrame, *groups: str, products: Column | None = None) -> DataFrame:
    """Percentage that each group has in the ``products`` of its segment, by default its
    rows with a product."""
    return (
        rows.groupBy("segmento", *groups)
        .agg((F.count("productid") if products is None else products).alias("products"))
        .select(
            "segmento",
            *groups,
            (ratio(F.col("products"), F.sum("products").over(_segment())) * 100).alias(
                "relative_freq_pct"
            ),
        )
    )
