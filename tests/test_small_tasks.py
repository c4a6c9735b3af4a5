"""The RFM step is reduced in tasks of bounded input, and the session's settings come back."""

from basketry.functions.sizing import small_tasks
from basketry.functions.storage import Scratch
from basketry.operators import rfm
from basketry.plans import catalog, fixtures

TARGET = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_settings_come_back_and_smaller_ones_stay(spark):
    before = spark.conf.get(TARGET), spark.conf.get(FIRST, None)
    with small_tasks(spark, 1024 * 1024):
        assert spark.conf.get(TARGET) == "1048576b"
        assert int(spark.conf.get(FIRST)) == 64 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        with small_tasks(spark, 2 * 1024 * 1024):
            assert spark.conf.get(TARGET) == "1048576b"
    assert (spark.conf.get(TARGET), spark.conf.get(FIRST, None)) == before


def test_the_write_of_customer_facts_has_small_tasks(spark, monkeypatch):
    seen = []
    table = Scratch.table

    def noted(self, df, name):
        seen.append((name, spark.conf.get(TARGET)))
        return table(self, df, name)

    monkeypatch.setattr(Scratch, "table", noted)
    rfm.rfm(fixtures.tickets(spark, "/root/testdata/sf0.001"))
    assert seen == [("facts", f"{16 * 1024 * 1024}b")]


def test_the_write_of_ticket_lines_has_small_tasks(spark, monkeypatch):
    seen = []
    table = Scratch.table

    def noted(self, df, name):
        seen.append((name, spark.conf.get(TARGET)))
        return table(self, df, name)

    monkeypatch.setattr(Scratch, "table", noted)
    lines = catalog.ticket_lines(spark, "/root/testdata/sf0.001")
    assert seen == [("lines", f"{16 * 1024 * 1024}b")]
    assert "Exchange" not in lines._jdf.queryExecution().executedPlan().toString()
