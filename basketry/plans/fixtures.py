"""Retail tables derived from the given TPC-H-like tables.

Copies, nulls and unknown values are made on purpose; every given row is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.functions.columns import segment_name
from basketry.functions.sizing import small_tasks
from basketry.functions.storage import Scratch
from basketry.operators.dataset import RetailTables
from basketry.operators.rfm import rfm
from basketry.operators.segments import N_CLUSTERS


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _known(customer: Column) -> Column:
    return _unless(customer % 97 == 0, customer)


def tickets(
    spark: SparkSession, sf_dir: str, anonymous: bool = False, numbered: bool = False
) -> DataFrame:
    """Order lines as ticket lines; the lines of every tenth order occur twice.

    ``anonymous`` takes the customer from the lines of some customers, which leaves
    these customers without a ticket. ``numbered`` adds a field that numbers the copies
    of a line where the order is divisible by 20, and is the same in all copies elsewhere.
    """
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    customer = F.col("o_custkey")
    if anonymous:
        customer = _known(customer)
    copies = F.when(F.col("l_orderkey") % 10 == 0, 2).otherwise(1)
    lines = _read(spark, sf_dir, "lineitem")
    orders = _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ticketid"),
        customer.alias("customerid"),
        F.col("o_orderpriority").alias("cardtype"),
        F.col("o_orderdate").cast("date").cast("string").alias("datekey"),
    )
    return (
        lines.join(orders, lines["l_orderkey"] == orders["ticketid"])
        .select(
            "customerid",
            F.col("l_suppkey").alias("storeid"),
            "cardtype",
            "datekey",
            "ticketid",
            F.col("l_partkey").alias("productid"),
            (price * (F.lit(1).cast("decimal(4,2)") - discount)).alias("extendedamount"),
            _unless(F.col("l_partkey") % 23 == 0, price).alias("originalamount"),
            (price * discount).alias("totaldiscount"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_linenumber").alias("line"),
            F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
        )
        .withColumn("line", F.when(F.col("ticketid") % 20 == 0, F.col("line") * 2 + F.col("copy")).otherwise(0))
        .drop("copy", *([] if numbered else ["line"]))
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    gender = F.when(key % 9 == 0, "U").when(key % 2 == 0, "M").otherwise("F")
    return _read(spark, sf_dir, "customer").select(
        key.alias("customerid"),
        _unless(key % 17 == 0, (14 + key % 62).cast("int")).alias("age"),
        gender.alias("gender"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = _read(spark, sf_dir, "supplier")
    nations = _read(spark, sf_dir, "nation")
    return suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"]).select(
        F.col("s_suppkey").alias("storeid"),
        _unless(F.col("s_suppkey") % 11 == 0, F.col("n_name")).alias("city"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    vat = F.when(size <= 10, "SUPERREDUCED").when(size <= 30, "REDUCED").otherwise("GENERAL")
    return _read(spark, sf_dir, "part").select(
        key.alias("productid"),
        F.col("p_type").alias("merchandisegroup"),
        _unless(key % 19 == 0, F.col("p_brand")).alias("merchandisefamily"),
        _unless(key % 29 == 0, vat).alias("vatdescription"),
        _unless(key % 31 == 0, F.col("p_name")).alias("article"),
    )


def classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of the brands; the class of a brand divisible by five is not known."""
    number = F.substring("p_brand", 7, 10).cast("int")
    marked = number % 7 != 0
    return (
        _read(spark, sf_dir, "part")
        .select(
            F.when(number % 5 != 0, F.col("p_brand")).alias("merchandisefamily"),
            F.when(marked & (number % 2 == 0), "YES").otherwise("NO").alias("healthy"),
            F.when(marked & (number % 2 == 1), "YES").otherwise("NO").alias("unhealthy"),
        )
        .distinct()
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFM table with segments by a rule, so that reports do not depend on K-Means."""
    return _segmented(rfm(tickets(spark, sf_dir)))


def _segmented(rfm_table: DataFrame) -> DataFrame:
    rule = F.expr(f"cast((customerid div 10) % {N_CLUSTERS} as int)")
    return rfm_table.withColumn("prediction", rule).withColumn("segmento", segment_name(F.col("prediction")))


def retail_tables(spark: SparkSession, sf_dir: str) -> RetailTables:
    return RetailTables(
        predictions=predictions(spark, sf_dir),
        tickets=tickets(spark, sf_dir, anonymous=True),
        customers=customers(spark, sf_dir),
        stores=stores(spark, sf_dir),
        products=products(spark, sf_dir),
        classification=classification(spark, sf_dir),
    )


def written_tables(spark: SparkSession, sf_dir: str, scratch: Scratch) -> RetailTables:
    """The same tables for a job that passes several times over whole ticket lines.

    Order lines meet their orders once: the distinct ticket lines are written, and the RFM
    step and all later passes read them. Taking away a customer makes no two lines of known
    customers equal."""
    with small_tasks(spark):
        lines = scratch.table(tickets(spark, sf_dir).distinct(), "tickets")
    return RetailTables(
        predictions=_segmented(rfm(lines, distinct=True)),
        tickets=lines.withColumn("customerid", _known(F.col("customerid"))),
        customers=customers(spark, sf_dir),
        stores=stores(spark, sf_dir),
        products=products(spark, sf_dir),
        classification=classification(spark, sf_dir),
        distinct_tickets=True,
    )
