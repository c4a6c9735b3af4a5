"""The derived relation against the joins and the distinct that define it."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators import dataset as ds
from basketry.operators.dataset import DATASET_COLUMNS, RetailTables, WrittenDataset
from tests.toys import frame, rows_of, tickets


def _defined(tables):
    """Left joins in the order of the definition, then distinct rows."""
    p, t, c, s, g, k = (
        tables.predictions.alias("p"),
        tables.tickets.alias("t"),
        tables.customers.alias("c"),
        tables.stores.alias("s"),
        tables.products.alias("g"),
        tables.classification.alias("k"),
    )
    joined = (
        p.join(t, F.col("p.customerid") == F.col("t.customerid"), "left")
        .join(c, F.col("t.customerid") == F.col("c.customerid"), "left")
        .join(s, F.col("t.storeid") == F.col("s.storeid"), "left")
        .join(g, F.col("t.productid") == F.col("g.productid"), "left")
        .join(k, F.col("g.merchandisefamily") == F.col("k.merchandisefamily"), "left")
    )
    owner = {
        **{x: "p" for x in ds.SEGMENT_COLUMNS},
        **{x: "t" for x in ds.LINE_COLUMNS},
        **{x: "c" for x in ds.CUSTOMER_COLUMNS},
        **{x: "s" for x in ds.STORE_COLUMNS},
        **{x: "g" for x in ds.PRODUCT_COLUMNS},
        **{x: "k" for x in ds.CLASS_COLUMNS},
    }
    return joined.select(*[f"{owner[x]}.{x}" for x in DATASET_COLUMNS]).distinct()


@pytest.fixture(scope="module")
def tables(spark):
    """Copies, null keys, unmatched keys and keys with several dimension rows."""
    return RetailTables(
        predictions=frame(
            spark,
            "customerid long, segmento string, prediction int",
            (1, "best", 0),
            (2, "best", 0),
            (3, "lost", 5),
            (4, "lost", 5),
            (5, "lost", 5),
            (6, "7", 7),
            (None, "loyal", 2),
            (1, "best", 0),
            (2, "risk", 4),
        ),
        tickets=tickets(
            spark,
            {},
            {},
            {"productid": 2},
            {"productid": 3, "storeid": 2},
            {"customerid": 2, "ticketid": 2, "storeid": 3},
            {"customerid": 2, "ticketid": 2, "storeid": None, "productid": None},
            {"customerid": 3, "ticketid": 3, "productid": 9, "originalamount": None},
            {"customerid": 3, "ticketid": 3, "productid": 4, "quantity": 2.0},
            {"customerid": 3, "ticketid": 3, "productid": 4, "quantity": 3.0},
            {"customerid": None, "ticketid": 4},
            {"customerid": 8, "ticketid": 5},
        ),
        customers=frame(
            spark, schemas.CUSTOMERS, (1, 30, "M"), (1, 30, "M"), (2, 40, "F"), (2, 41, "F"), (3, None, None)
        ),
        stores=frame(
            spark, schemas.STORES, (1, "Oviedo"), (2, None), (3, "Vigo"), (3, "Lugo"), (None, "Nowhere")
        ),
        products=frame(
            spark,
            schemas.PRODUCTS,
            (1, "g", "fruit", "REDUCED", "apple"),
            (2, "g", "sweets", None, "cake"),
            (3, "g", None, "GENERAL", None),
            (4, "g", "fruit", "REDUCED", "pear"),
            (4, "g", "drinks", "REDUCED", "pear"),
            (None, "g", "fruit", None, "none"),
        ),
        classification=frame(
            spark,
            schemas.CLASSIFICATION,
            ("fruit", "YES", "NO"),
            ("drinks", "YES", "NO"),
            ("drinks", "NO", "YES"),
            (None, "NO", "NO"),
        ),
    )


@pytest.fixture(scope="module")
def defined(tables):
    return _defined(tables).cache()


def test_whole_relation(tables, defined):
    assert tables.dataset().columns == list(DATASET_COLUMNS)
    assert rows_of(tables.dataset()) == rows_of(defined)
    assert tables.dataset().schema.simpleString() == defined.schema.simpleString()


PROJECTIONS = [
    ("segmento", "customerid", "age"),
    ("segmento", "customerid", "gender"),
    ("segmento", "productid", "merchandisefamily"),
    ("segmento", "customerid", "ticketid", "productid", "quantity"),
    ("segmento", "customerid", "ticketid", "productid", "vatdescription"),
    ("segmento", "customerid", "ticketid", "productid", "healthy", "unhealthy"),
    ("segmento", "customerid", "ticketid", "productid", "originalamount", "extendedamount"),
    ("segmento", "article"),
    ("segmento", "city", "customerid"),
    ("segmento", "customerid", "gender", "age"),
    ("extendedamount",),
    ("customerid", "healthy"),
    ("prediction", "city", "article"),
    DATASET_COLUMNS,
]


@pytest.mark.parametrize("columns", PROJECTIONS, ids=lambda c: "-".join(c)[:40])
def test_projections(tables, defined, columns):
    assert rows_of(tables.rows(*columns)) == rows_of(defined.select(*columns))
    expected = rows_of(defined.select(*columns).distinct())
    assert rows_of(tables.distinct_rows(*columns)) == expected
    assert rows_of(WrittenDataset(defined).distinct_rows(*columns)) == expected


def test_customers_without_tickets_leave_one_row_each_segment(tables):
    lost = tables.dataset().where("customerid is null")
    assert rows_of(lost, "segmento", "prediction") == [("7", 7), ("lost", 5), ("loyal", 2)]


def test_duplicate_dimension_key_multiplies_lines(tables):
    rows = tables.dataset().where("ticketid = 2 and storeid = 3 and segmento = 'best'")
    assert rows_of(rows, "city", "age") == [("Lugo", 40), ("Lugo", 41), ("Vigo", 40), ("Vigo", 41)]


def test_large_dimensions_join_without_broadcast(spark, tables, defined):
    tables = dataclasses.replace(tables, broadcast_bytes=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = tables.dataset()
        assert rows_of(result) == rows_of(defined)
        assert "BroadcastHashJoin" not in result._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
