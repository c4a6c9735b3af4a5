"""Properties of physical plans that matter on large inputs."""

import re
import shutil

import pytest

import __spark_entry__ as entry_points
from basketry import schemas
from basketry.functions import sizing
from basketry.functions.sizing import broadcast_within, measured_bytes
from basketry.operators import insights, rfm
from basketry.operators.dataset import RetailTables
from basketry.sources import readers
from tests.toys import frame, rows_of, tickets

SF_DIR = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Tables stored as Parquet; one customer owns a third of the lines."""
    folder = tmp_path_factory.mktemp("plans")
    lines = [
        {
            "customerid": 1 if i % 3 == 0 else i % 40 + 2,
            "ticketid": i // 2,
            "productid": i % 7,
            "storeid": i % 3,
        }
        for i in range(6000)
    ]
    data = {
        "predictions": frame(
            spark,
            "customerid long, segmento string, prediction int",
            *[(i, "best" if i % 2 else "lost", 0) for i in range(1, 60)],
        ),
        "tickets": tickets(spark, *lines),
        "customers": frame(spark, schemas.CUSTOMERS, *[(i, 20 + i, "M") for i in range(1, 60)]),
        "stores": frame(spark, schemas.STORES, *[(i, f"c{i}") for i in range(3)]),
        "products": frame(
            spark, schemas.PRODUCTS, *[(i, "g", f"f{i}", "A", f"a{i}") for i in range(7)]
        ),
        "classification": frame(spark, schemas.CLASSIFICATION, ("f1", "YES", "NO")),
    }
    for name, table in data.items():
        table.write.parquet(f"{folder}/{name}")
    return RetailTables(**{name: spark.read.parquet(f"{folder}/{name}") for name in data})


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_no_query_joins_every_pair(spark, name):
    plan = _plan(entry_points.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Python" not in plan


def test_reports_read_only_their_columns(stored):
    plan = _plan(insights.age_mean(stored))
    schemas_read = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert sorted(schemas_read) == [
        "customerid:bigint",
        "customerid:bigint,age:int",
        "customerid:bigint,segmento:string",
    ]
    assert "PushedFilters: [IsNotNull(age), IsNotNull(customerid)]" in plan
    plan = _plan(insights.discount_share(stored))
    assert "IsNotNull(originalamount)" in plan
    assert "datekey" not in plan and "cardtype" not in plan


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_tickets_are_read_once(spark, stored, tmp_path, fmt):
    """One scan in the pass that writes the facts, and none after it."""
    path = tmp_path / "tickets"
    stored.tickets.write.format(fmt).save(str(path))
    read = readers.read_tickets(spark, str(path), fmt)
    assert _plan(rfm.customer_facts(read)).count("FileScan") == 1
    table = rfm.rfm(read)
    shutil.rmtree(path)
    assert table.count() == 41
    assert table.where("recency = 0").count() > 0


def test_lines_combine_before_each_shuffle(stored):
    """Every shuffle of lines has a partial aggregate right below it."""
    plan = _plan(rfm.customer_facts(stored.tickets)).splitlines()
    below = [plan[i + 1] for i, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert len(below) == 3
    assert all("HashAggregate" in line for line in below)


def test_copies_of_a_line_collapse_on_the_map_side(spark, tmp_path):
    tickets(spark, *[{}] * 3000).repartition(3).write.parquet(f"{tmp_path}/tickets")
    rolled = rfm.ticket_lines(spark.read.parquet(f"{tmp_path}/tickets"))
    assert len(rolled.collect()) == 1
    records = _shuffled_records(rolled._jdf.queryExecution().executedPlan())
    assert len(records) == 2 and max(records) <= 3


def _shuffled_records(node):
    """Records written by each shuffle of an executed plan."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return _shuffled_records(node.executedPlan())
    if "QueryStage" in node.nodeName():
        return _shuffled_records(node.plan())
    own = node.metrics().get("shuffleRecordsWritten")
    children = [node.children().apply(i) for i in range(node.children().size())]
    below = [records for child in children for records in _shuffled_records(child)]
    return ([own.get().value()] if node.nodeName() == "Exchange" else []) + below


def test_rank_filter_limits_each_map_task(stored):
    plan = _plan(insights.top_families(insights.family_counts(stored)))
    assert re.search(r"WindowGroupLimit .* 10, Final", plan)
    assert re.search(r"WindowGroupLimit .* 10, Partial", plan)


@pytest.mark.parametrize(
    "report",
    [
        insights.family_counts,
        insights.products_per_ticket,
        insights.vat_share,
        insights.discount_share,
        RetailTables.dataset,
    ],
    ids=lambda report: report.__name__,
)
def test_hot_customer_is_split(spark, stored, report):
    """The join with the predictions splits the partition of a hot customer."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        result = report(stored)
        found = rows_of(result)
        assert "SortMergeJoin(skew=true)" in _plan(result)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert found == rows_of(report(stored))


def test_broadcast_only_within_the_limit(spark):
    df = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "k long, text string")
    assert measured_bytes(df) == 50 * (100 + 2 * 16)
    assert measured_bytes(df.where("k < 0")) == 0
    hint = "strategy=broadcast"
    analyzed = lambda d: d._jdf.queryExecution().analyzed().toString()
    assert hint in analyzed(broadcast_within(df))
    assert hint not in analyzed(broadcast_within(df, limit=1000))
    assert sizing.BROADCAST_BYTES < 2**30
