"""What jobs leave on disk, and in how few bytes ticket lines are shuffled."""

import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions.storage import Scratch, transient_shuffles
from basketry.operators import rfm
from basketry.plans import catalog
from basketry.sources import readers
from tests.test_plain_lines import LINE, _parsed_calls, _written
from tests.toys import rows_of, tickets

SF_DIR = "/root/testdata/sf0.001"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = disk.getAllFiles().mkString("\n").split("\n")
    return {name for name in names if "/shuffle_" in name and name.endswith(".data")}


@pytest.mark.parametrize("name", ["run_predictions", "run_threshold_folders"])
def test_batch_jobs_leave_no_shuffled_lines(spark, name, monkeypatch):
    """The lines' shuffles are gone when the next step starts, and settings come back."""
    seen = []
    bounds = rfm.exact_quantiles_of
    monkeypatch.setattr(rfm, "exact_quantiles_of", lambda *a: seen.append(_shuffle_files(spark)) or bounds(*a))
    before = _shuffle_files(spark), spark.conf.get(CLEANUP, None)
    catalog.queries()[name](spark, SF_DIR)
    assert seen and all(files <= before[0] for files in seen)
    assert spark.conf.get(CLEANUP, None) == before[1]


def test_predictions_of_the_catalogue_are_compressed(spark, monkeypatch):
    made = []
    trained = catalog._trained
    monkeypatch.setattr(catalog, "_trained", lambda *a, **k: made.append(trained(*a, **k)) or made[-1])
    labels = catalog.run_predictions(spark, SF_DIR)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    for folder in ("trained/all", "trained/segments", "batch/all", "batch/segments"):
        names = [row["path"] for row in listed.load(f"{made[0]}/{folder}").select("path").collect()]
        assert names and all(name.endswith(".json.gz") for name in names if "/part-" in name)
    assert labels.count() == readers.read_predictions(spark, f"{made[0]}/trained/all").count()


AMOUNTS = ["10", "-0.0001", "0.00001", "12345678901234.5678", "123456789012345.6", "123456789012345678.0123456789", None]
KEYS = ["2020-01-02", "2020-1-2", "x", "", None, "2020-02-30"]


def _odd(spark):
    """Lines that differ in one amount or in the date key alone, each of them twice."""
    lines = [{"extendedamount": a} for a in AMOUNTS] + [{"totaldiscount": a} for a in AMOUNTS]
    lines += [{"datekey": key} for key in KEYS]
    texts = {a: "string" for a in ("extendedamount", "totaldiscount")}
    kinds = ", ".join(
        f"{f.name} {texts.get(f.name, f.dataType.simpleString())}" for f in schemas.TICKETS
    )
    base = tickets(spark, {}).first().asDict()
    rows = [tuple(({**base, "extendedamount": "10", "totaldiscount": "0"} | line)[f.name] for f in schemas.TICKETS) for line in lines]
    made = spark.createDataFrame(rows + rows, kinds)
    return made.withColumns({a: F.col(a).cast(schemas.AMOUNT) for a in texts})


def test_narrow_lines_are_equal_where_lines_are(spark):
    lines = _odd(spark)
    distinct = lines.distinct().count()
    assert distinct == len(AMOUNTS) * 2 + len(KEYS)
    narrow = rfm.narrow_lines(lines)
    assert narrow.distinct().count() == distinct
    kept = narrow.select(rfm.narrow_amount(lines, "extendedamount").alias("a"))
    assert kept.schema["a"].dataType == schemas.AMOUNT
    assert rows_of(kept) == rows_of(lines.select(F.col("extendedamount").alias("a")))


def test_facts_of_narrow_lines(spark):
    lines = _odd(spark)
    assert rows_of(rfm.customer_facts(lines)) == rows_of(rfm.customer_facts(lines.distinct(), distinct=True))


def test_lines_are_shuffled_in_fewer_bytes(spark, tmp_path):
    """Bytes of the first shuffle of customer facts, against that of whole lines."""
    path = str(tmp_path / "tickets")
    catalog._write_tickets(catalog.fixtures.tickets(spark, SF_DIR), path)
    read = readers.read_tickets(spark, path)
    whole = _first_shuffle(read.dropDuplicates())
    assert _first_shuffle(rfm.customer_facts(read)) < 0.85 * whole


def _first_shuffle(df):
    df.collect()
    return _sizes(df._jdf.queryExecution().executedPlan())[-1]


def _sizes(node):
    if node.nodeName() == "AdaptiveSparkPlan":
        return _sizes(node.executedPlan())
    if "QueryStage" in node.nodeName():
        return _sizes(node.plan())
    below = [size for i in range(node.children().size()) for size in _sizes(node.children().apply(i))]
    own = [node.metrics().get("shuffleBytesWritten").get().value()] if node.nodeName() == "Exchange" else []
    return own + below


def test_shuffles_are_kept_outside(spark):
    with transient_shuffles(spark):
        assert spark.conf.get(CLEANUP) == "true"
        with Scratch(spark) as scratch:
            assert scratch.table(spark.range(9).groupBy("id").count(), "t").count() == 9


ODD_LINES = [
    LINE.replace("1.50", "-1.50") + "}",
    LINE.replace("1.50", "-0") + "}",
    LINE.replace("1.50", "01.5") + "}",
    LINE.replace("1.50", "1.") + "}",
    LINE.replace("1.50", "1.12345678901") + "}",
    LINE.replace("1.50", "123456789012345678") + "}",
    LINE.replace("1.50", "12345678901234567.0123456789") + "}",
    LINE.replace("2.0", "12345678901234567.0123456789") + "}",
    LINE.replace("5,", "-5,", 1) + "}",
    LINE.replace("5,", "05,", 1) + "}",
    LINE.replace("5,", "99999999999999999,", 1) + "}",
    LINE.replace("5,", "9223372036854775808,", 1) + "}",
    LINE.replace("5,", "5.0,", 1) + "}",
    LINE.replace('"a"', '"ñandú"') + "}",
    LINE.replace('"a"', '"日本"') + "}",
    LINE.replace('"a"', '"\U0001f600"') + "}",
    LINE.replace('"a"', '"a\tb"') + "}",
    LINE.replace('"a"', '""') + "}",
    LINE.replace('"a"', '" a "') + "}",
    LINE.replace('"a"', "null") + "}",
    LINE.replace('"a"', '"{}[],:"') + "}",
    LINE + ",}",
    LINE + "},",
    LINE + ',"line":00}',
    LINE + ',"line":-0}',
    LINE + ',"line":""}',
    LINE + ',"line":null}',
    LINE + ',"line":"é"}',
    LINE + ',"line":1,"more":2}',
    LINE + "} ",
    '{"line":0}',
    '{,"line":0}',
    '{"storeid":7,"customerid":5}',
    '{"customerid":5,"line":0}',
    '{"customerid":5}',
    '{"quantity":2}',
    "{",
    "[]",
    "[{}]",
    "null",
]


def test_odd_lines_give_the_rows_of_the_parser(spark, tmp_path, monkeypatch):
    path = _written(tmp_path / "lines.json", ODD_LINES)
    fast = _parsed_calls(spark, monkeypatch, path, plain=True)
    assert fast == _parsed_calls(spark, monkeypatch, path, plain=False)
    assert len(fast) == len(ODD_LINES) - 1
