"""Jobs that pass several times over whole ticket lines join order lines and orders once."""

from basketry.functions.storage import Scratch
from basketry.operators import dataset
from basketry.operators.dataset import DATASET_COLUMNS
from basketry.plans import catalog, fixtures
from tests.toys import rows_of

SF_DIR = "/root/testdata/sf0.001"


def test_orders_are_not_read_after_the_tickets_are_written(spark):
    plan = catalog.analysis_dataset(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "o_custkey" not in plan and "l_orderkey" not in plan


def test_rows_are_those_of_the_unwritten_tables(spark):
    plain = fixtures.retail_tables(spark, SF_DIR)
    written = fixtures.written_tables(spark, SF_DIR, Scratch(spark))
    assert rows_of(written.predictions) == rows_of(plain.predictions)
    texts = [f"cast({c} as string)" for c in DATASET_COLUMNS]
    count = lambda tables: tables.dataset().selectExpr(*texts)
    assert count(plain).exceptAll(count(written)).isEmpty()
    assert count(written).exceptAll(count(plain)).isEmpty()


def test_no_city_goes_along_with_the_lines_to_large_products(spark, monkeypatch):
    joined = []
    join = dataset.join_dimension

    def noted(lines, dimension, key, **given):
        joined.append((key, "city" in lines.columns))
        return join(lines, dimension, key, **given)

    monkeypatch.setattr(dataset, "join_dimension", noted)
    fixtures.retail_tables(spark, SF_DIR).dataset()
    assert joined == [("productid", False), ("storeid", False)]
