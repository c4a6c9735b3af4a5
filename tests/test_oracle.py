"""Every query against its SQL twin on the given tables."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from basketry.plans import catalog, oracle

SF_DIR = "/root/testdata/sf0.01"
QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _normal(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_normal(row[i]) for i in order) for row in rows]
    return sorted(rows, key=lambda row: [(v is None, v if v is not None else 0) for v in row])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = database.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    found = _sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    wanted = _sorted_rows(columns, expected.fetchall())
    assert len(found) > 0
    assert found == wanted


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["customerid", "recency", "frequency", "monetary"]
    assert result.count() == 150
