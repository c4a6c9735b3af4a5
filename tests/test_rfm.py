import datetime

import pytest

from basketry import schemas
from basketry.functions.storage import Scratch
from basketry.operators import rfm
from tests.toys import rows_of, tickets

RFM = "customerid long, recency int, frequency long, monetary double"


def test_identical_line_counts_once(spark):
    lines = tickets(spark, {}, {}, {"productid": 2}, {"quantity": 2.0})
    assert rows_of(rfm.ticket_lines(lines), "productid", "extendedamount", "quantity") == [
        (1, 20, 3.0),
        (2, 10, 1.0),
    ]
    assert rows_of(rfm.rfm(lines)) == [(1, 0, 1, 30.0)]


def test_roll_up_leaves_rfm_unchanged(spark):
    lines = tickets(
        spark,
        {"ticketid": 1},
        {"ticketid": 1, "quantity": 2.0},
        {"ticketid": 2, "datekey": "2020-01-05", "extendedamount": None},
        {"customerid": 2, "ticketid": 2, "datekey": "2020-01-04"},
    )
    rolled = rfm.ticket_lines(lines).withColumn("datekey", rfm.F.col("date").cast("string"))
    assert rows_of(rfm.rfm(rolled)) == rows_of(rfm.rfm(lines)) == [(1, 0, 2, 20.0), (2, 1, 1, 10.0)]


def test_recency_from_batch_date_or_given_day(spark):
    lines = tickets(
        spark,
        {"datekey": "2020-01-01"},
        {"datekey": "2020-01-11", "ticketid": 2},
        {"customerid": 2, "ticketid": 3, "datekey": "2020-01-31"},
    )
    assert rows_of(rfm.rfm(lines), "customerid", "recency") == [(1, 20), (2, 0)]
    later = datetime.date(2020, 2, 10)
    assert rows_of(rfm.rfm(lines, later), "customerid", "recency") == [(1, 30), (2, 10)]
    with Scratch(spark) as scratch:
        batch = rfm.rfm_batch(lines, scratch, later)
        assert (batch.last_date, batch.customers, batch.undated) == (datetime.date(2020, 1, 31), 2, 0)
        assert rows_of(batch.table) == rows_of(rfm.rfm(lines, later))


def test_unparsable_date_is_null(spark):
    lines = tickets(
        spark,
        {"datekey": "20-13-01"},
        {"datekey": "2020-01-01", "ticketid": 2},
        {"datekey": "2020-01-03", "customerid": 2},
        {"datekey": None, "customerid": 3},
    )
    assert rows_of(rfm.rfm(lines), "customerid", "recency") == [(1, 2), (2, 0), (3, None)]


def test_null_customer_is_a_group(spark):
    lines = tickets(spark, {}, {"customerid": None}, {"customerid": None, "ticketid": 2})
    assert rows_of(rfm.rfm(lines), "customerid", "frequency") == [(1, 1), (None, 2)]


def test_bounds_trim_and_outliers(spark):
    table = spark.createDataFrame([(i, i, i, float(i)) for i in range(1, 101)], RFM)
    bounds = rfm.trim_bounds(table, 0.95, 0.99, 0.99)
    assert bounds == {"recency": 95.0, "frequency": 99.0, "monetary": 99.0}
    assert rfm.trim(table, bounds).count() == 94
    assert rfm.outliers(table, bounds).count() == 6
    assert rfm.trim_audit(table, bounds).first().asDict() == {
        "total": 100,
        "trimmed": 94,
        "outliers": 6,
        "null_metrics": 0,
    }
    assert rows_of(rfm.bounds_frame(spark, bounds)) == [
        ("frequency", 99.0),
        ("monetary", 99.0),
        ("recency", 95.0),
    ]


@pytest.mark.parametrize("off", [None, 0, 0.0])
def test_bound_off(spark, off):
    table = spark.createDataFrame([(i, i, i, float(i)) for i in range(1, 11)], RFM)
    bounds = rfm.trim_bounds(table, off, off, off)
    assert bounds == {"recency": None, "frequency": None, "monetary": None}
    assert rfm.trim(table, bounds).count() == 10
    assert rfm.outliers(table, bounds).count() == 0


def test_monetary_bound_has_a_switch_of_its_own(spark):
    table = spark.createDataFrame([(i, i, i, float(i)) for i in range(1, 11)], RFM)
    assert rfm.trim_bounds(table, m_percentile=0.5)["monetary"] == 5.0
    assert rfm.trim_bounds(table, f_percentile=0.5) == {
        "recency": None,
        "frequency": 5.0,
        "monetary": None,
    }


def test_null_metric_is_neither_trimmed_nor_outlier(spark):
    table = spark.createDataFrame(
        [(1, None, 1, 1.0), (2, None, 9, 1.0), (3, 1, 1, 1.0), (4, 9, 9, 9.0)], RFM
    )
    bounds = {"recency": 5.0, "frequency": 5.0, "monetary": 5.0}
    assert rows_of(rfm.trim(table, bounds), "customerid") == [(3,)]
    assert rows_of(rfm.outliers(table, bounds), "customerid") == [(2,), (4,)]
    assert rfm.trim_audit(table, bounds).first()["null_metrics"] == 2


def test_thresholds(spark):
    table = spark.createDataFrame([(i, i, 2 * i, float(3 * i)) for i in range(1, 9)], RFM)
    quartiles = rfm.thresholds(table)
    assert quartiles == {
        "recency": [2.0, 4.0, 6.0],
        "frequency": [4.0, 8.0, 12.0],
        "monetary": [6.0, 12.0, 18.0],
    }
    assert rfm.thresholds_frame(spark, quartiles).schema == schemas.THRESHOLDS


def test_trimming_everything_is_an_error(spark):
    table = spark.createDataFrame([(i, 1, 1, 1.0) for i in range(5)], RFM)
    bounds = rfm.trim_bounds(table, 0.5, 0.5, 0.5)
    with pytest.raises(ValueError, match="no quartiles"):
        rfm.thresholds(rfm.trim(table, bounds))
