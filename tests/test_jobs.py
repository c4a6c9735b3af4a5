"""Files in, files out: training, scoring and reports."""

import csv
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.functions import storage
from basketry.functions.columns import SEGMENTS
from basketry.functions.storage import Scratch
from basketry.operators import rfm
from basketry.operators.dataset import RetailTables, WrittenDataset
from basketry.plans import jobs
from basketry.plans.catalog import PERCENTILES
from basketry.sources import readers, writers
from tests.toys import frame, rows_of, tickets


def _lines(count, seed=5):
    draw = random.Random(seed)
    for ticket in range(count):
        customer = draw.randrange(1, 61)
        for _ in range(draw.randrange(1, 4)):
            yield {
                "customerid": customer,
                "ticketid": ticket,
                "storeid": draw.randrange(1, 4),
                "productid": draw.randrange(1, 9),
                "datekey": f"2020-{draw.randrange(1, 13):02d}-{draw.randrange(1, 29):02d}",
                "extendedamount": str(draw.randrange(1, 9000) / 100),
                "originalamount": None if draw.random() < 0.1 else "45.5",
            }


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Ticket files as JSON lines in several folders matched by one glob."""
    folder = tmp_path_factory.mktemp("jobs")
    lines = list(_lines(600))
    for part in range(3):
        tickets(spark, *lines[part::3]).write.json(f"{folder}/tickets_{part}.json")
    return folder


@pytest.fixture(scope="module")
def trained(spark, folder):
    return jobs.train(
        spark,
        input=f"{folder}/tickets_*.json",
        model_output=f"{folder}/model",
        quartile_output=f"{folder}/quartiles",
        prediction_output=f"{folder}/train",
        scaler_output=f"{folder}/scaler",
        **PERCENTILES,
    )


def test_training_summary_and_artefacts(spark, folder, trained):
    assert trained.audit["total"] == 60
    assert trained.audit["trimmed"] + trained.audit["outliers"] == 60
    assert set(trained.bounds) == set(trained.quartiles) == {"recency", "frequency", "monetary"}
    assert readers.read_thresholds(spark, f"{folder}/quartiles") == trained.quartiles
    assert readers.read_centroids(spark, f"{folder}/model") == trained.fit.centroids
    assert len(trained.fit.centroids) == len(trained.fit.seeds) == 6


def test_prediction_files(spark, folder, trained):
    everyone = readers.read_predictions(spark, f"{folder}/train/all")
    assert everyone.count() == 60
    assert everyone.where("scaled_features is null or prediction_label is null").count() == 0
    split = spark.read.schema(schemas.PREDICTIONS).json(f"{folder}/train/segments")
    columns = ("customerid", "segmento", "rfm_score", "prediction")
    assert rows_of(split, *columns) == rows_of(everyone, *columns)
    best = everyone.where("segmento = 'best'").count()
    assert spark.read.json(f"{folder}/train/segments/segmento=best").count() == best > 0


def test_run_on_the_same_input_gives_the_same_segments(spark, folder, trained):
    columns = ("customerid", "rfm_score", "prediction", "segmento", "prediction_label")
    expected = rows_of(readers.read_predictions(spark, f"{folder}/train/all"), *columns)
    for name, scaler in (("refitted", None), ("saved", f"{folder}/scaler")):
        jobs.run(
            spark,
            input=f"{folder}/tickets_*.json",
            model_input=f"{folder}/model",
            quartile_input=f"{folder}/quartiles",
            prediction_output=f"{folder}/run_{name}",
            scaler_input=scaler,
            plain_folders=True,
        )
        found = readers.read_predictions(spark, f"{folder}/run_{name}/all")
        assert rows_of(found, *columns) == expected
        best = readers.read_predictions(spark, f"{folder}/run_{name}/best")
        assert rows_of(best, "customerid") == rows_of(found.where("segmento = 'best'"), "customerid")
        again = readers.read_predictions(spark, f"{folder}/run_{name}/[b-r]*")
        assert again.count() == found.where("segmento != 'zz'").count()


def _labelled(spark, names):
    rows = [(i, name, float(i)) for i, name in enumerate(names)]
    return spark.createDataFrame(rows, "customerid long, segmento string, monetary double").repartition(3)


def _folder_rows(spark, path):
    found = spark.read.schema("customerid long, segmento string, monetary double").json(str(path))
    return sorted(tuple(r) for r in found.select("customerid", "segmento", "monetary").collect())


@pytest.mark.parametrize("plain", [False, True])
def test_both_layouts_come_from_one_pass(spark, tmp_path, plain):
    names = ["best", "lost", "best", "7", "risk"] * 4
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = _labelled(spark, names)
    for _ in range(2):  # the second time over the first
        writers.write_predictions(source.mapInArrow(noted, source.schema), str(tmp_path), plain_folders=plain)
    assert seen.value == 2 * len(names)  # each row was computed once a write
    wanted = sorted((i, name, float(i)) for i, name in enumerate(names))
    assert _folder_rows(spark, tmp_path / "all") == wanted
    for name in {*names, "promising"} if plain else set(names):
        place = tmp_path / name if plain else tmp_path / "segments" / f"segmento={name}"
        found = _folder_rows(spark, place if plain else tmp_path / "segments")
        assert [r for r in found if r[1] == name] == [r for r in wanted if r[1] == name]
        assert (place / "_SUCCESS").exists() or not plain
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(
        ["all", *(sorted({*names, *SEGMENTS}) if plain else ["segments"])]
    )


@pytest.mark.parametrize("place", ["all", "best", "risk"])
def test_a_failed_move_leaves_the_old_folders(spark, tmp_path, monkeypatch, place):
    names = ["best", "risk", "lost"]
    writers.write_predictions(_labelled(spark, names), str(tmp_path), plain_folders=True)
    before = {n: _folder_rows(spark, tmp_path / n) for n in ("all", *names)}
    move = writers._FileSystem.move

    def broken(self, source, target):
        if target == f"{tmp_path}/{place}" and "/old/" not in source:
            raise OSError("refused")
        move(self, source, target)

    monkeypatch.setattr(writers._FileSystem, "move", broken)
    with pytest.raises(OSError, match="refused"):
        writers.write_predictions(_labelled(spark, names * 5), str(tmp_path), plain_folders=True)
    assert {n: _folder_rows(spark, tmp_path / n) for n in before} == before
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_a_failed_write_leaves_the_old_folders_and_none_of_its_own(spark, tmp_path):
    writers.write_predictions(_labelled(spark, ["best"]), str(tmp_path))
    broken = _labelled(spark, ["best", "lost"]).withColumn("monetary", F.raise_error(F.lit("stop")).cast("double"))
    with pytest.raises(Exception, match="stop"):
        writers.write_predictions(broken, str(tmp_path))
    assert _folder_rows(spark, tmp_path / "all") == [(0, "best", 0.0)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["all", "segments"]


def test_no_predictions_make_empty_folders(spark, tmp_path):
    writers.write_predictions(_labelled(spark, ["best"]).where("false"), str(tmp_path), plain_folders=True)
    assert _folder_rows(spark, tmp_path / "all") == _folder_rows(spark, tmp_path / "best") == []


def test_run_on_one_file_counts_from_its_own_last_date(spark, folder, trained):
    jobs.run(
        spark,
        input=f"{folder}/tickets_1.json",
        model_input=f"{folder}/model",
        quartile_input=f"{folder}/quartiles",
        prediction_output=f"{folder}/one",
    )
    found = readers.read_predictions(spark, f"{folder}/one/all")
    assert found.agg(F.min("recency")).first()[0] == 0


def test_a_model_is_not_written_over_another(spark, folder, trained):
    with pytest.raises(FileExistsError):
        jobs.train(
            spark,
            input=f"{folder}/tickets_*.json",
            model_output=f"{folder}/model",
            quartile_output=f"{folder}/q",
            prediction_output=f"{folder}/p",
        )


def test_parquet_tickets_give_the_same_thresholds(spark, folder, trained):
    readers.read_tickets(spark, f"{folder}/tickets_*.json").write.parquet(f"{folder}/columns")
    summary = jobs.train(
        spark,
        input=f"{folder}/columns",
        input_format="parquet",
        model_output=f"{folder}/model2",
        quartile_output=f"{folder}/quartiles2",
        quartile_folders=True,
        prediction_output=f"{folder}/train2",
        **PERCENTILES,
    )
    assert summary.quartiles == trained.quartiles
    assert readers.read_threshold_folders(spark, f"{folder}/quartiles2") == trained.quartiles


def test_threshold_folders_read_in_numeric_order(spark, tmp_path):
    quartiles = {
        "recency": [66.0, 158.0, 304.0],
        "frequency": [8.0, 10.0, 12.0],
        "monetary": [1529341.488, 1982739.2302, 2487932.4003],
    }
    writers.write_threshold_folders(spark, quartiles, str(tmp_path))
    assert readers.read_threshold_folders(spark, str(tmp_path)) == quartiles
    lines = [row for part in (tmp_path / "f_quartile").glob("part*") for row in csv.reader(part.open())]
    assert sorted(lines) == [["10.0"], ["12.0"], ["8.0"]]
    writers.write_thresholds(spark, quartiles, str(tmp_path / "table"))
    assert readers.read_thresholds(spark, str(tmp_path / "table")) == quartiles


def test_dimension_readers(spark, tmp_path):
    customers = frame(spark, schemas.CUSTOMERS, (1, 30, "M"), (2, None, None))
    stores = frame(spark, schemas.STORES, (1, "Vigo"))
    products = frame(spark, schemas.PRODUCTS, (1, "g", "fruit", None, "apple"))
    for name, table, reader in (
        ("customers", customers, readers.read_customers),
        ("stores", stores, readers.read_stores),
        ("products", products, readers.read_products),
    ):
        table.write.json(f"{tmp_path}/{name}.json")
        assert rows_of(reader(spark, f"{tmp_path}/{name}.json")) == rows_of(table)
    path = tmp_path / "classes.csv"
    path.write_text("id,unhealthy,merchandisefamily,healthy\n1,NO,fruit,YES\n2,YES,sweets,NO\n")
    assert rows_of(readers.read_classification(spark, str(path))) == [
        ("fruit", "YES", "NO"),
        ("sweets", "NO", "YES"),
    ]


def test_ticket_fields_in_json(spark, tmp_path):
    (tmp_path / "tickets_1.json").write_text(
        '{"customerid": 7, "ticketid": 1, "extendedamount": 12.34567, "quantity": 2, "till": "x"}\n'
        '{"customerid": null, "datekey": "2020-02-01", "originalamount": 5}\n'
    )
    tickets = readers.read_tickets(spark, f"{tmp_path}/tickets_*.json")
    assert tickets.columns == [*schemas.TICKETS.names, "other_fields"]
    columns = ("customerid", "datekey", "extendedamount", "originalamount", "quantity")
    found = rows_of(tickets, *columns, "other_fields")
    first, second = (7, None, Decimal("12.34567"), None, 2.0), (None, "2020-02-01", None, Decimal("5"), None)
    assert found == [(*first, '{"till":"x"}'), (*second, None)]
    typed = readers.read_tickets(spark, f"{tmp_path}/tickets_*.json", further="till string")
    assert rows_of(typed, *columns, "till") == [(*first, "x"), (*second, None)]


def test_equal_lines_have_one_form(spark, tmp_path):
    (tmp_path / "t.json").write_text(
        '{"customerid": 1, "till": 2, "at": {"y": 1.50, "x": [1.0, null]}, "note": null}\n'
        ' {"at":{"x":[1,null],"y":1.5},"till":2.0,"customerid":"1"} \n'
        '\n  \t\n'
        '[{"customerid": 1, "till": 2, "at": {"y": 1.5, "x": [1, null]}}, {"customerid": 1}]\n'
        '{"customerid": 1, "till": "2", "at": {"y": 1.5, "x": [1, null]}}\n'
        '{"customerid": 1, "a\\"b.c": true}\n'
    )
    tickets = readers.read_tickets(spark, f"{tmp_path}/t.json")
    found = rows_of(tickets.dropDuplicates(), "customerid", "other_fields")
    assert sorted(found, key=str) == sorted([
        (1, None), (1, '{"at":{"x":[1,null],"y":1.5},"till":2}'), (1, '{"at":{"x":[1,null],"y":1.5},"till":"2"}'),
        (1, '{"a\\"b.c":true}'),
    ], key=str)


def test_lines_that_are_no_objects(spark, tmp_path):
    (tmp_path / "t.json").write_text('no json\n{"customerid": 1\n5\n{"customerid": 2, "customerid": 3, "x": 1}\n[]\n')
    tickets = readers.read_tickets(spark, f"{tmp_path}/t.json", invalid="null")
    found = sorted(rows_of(tickets, "customerid", "other_fields"), key=str)
    assert ("no json" in {o for _, o in found}) and (None, "5") in found
    assert [c for c, o in found if o and "3" in o] == [3]
    assert len(found) == 4


def test_json_is_read_once_and_empty_files_give_no_lines(spark, tmp_path):
    (tmp_path / "t.json").write_text("")
    tickets = readers.read_tickets(spark, f"{tmp_path}/t.json")
    plan = tickets._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "FileScan json" not in plan
    with Scratch(spark) as scratch:
        batch = rfm.rfm_batch(tickets, scratch)
        assert (batch.table.count(), batch.last_date, batch.customers) == (0, None, 0)


def test_lines_that_differ_in_any_field_count_apart(spark, tmp_path):
    line = '{"customerid": 1, "ticketid": 1, "datekey": "2020-01-01", "extendedamount": 5.0, "line": %d}\n'
    (tmp_path / "t.json").write_text(line % 1 + line % 2 + line % 2)
    path = f"{tmp_path}/t.json"

    def paid(**options):
        return rfm.rfm(readers.read_tickets(spark, path, **options)).first()["monetary"]

    assert paid() == paid(further="line int") == 10.0
    assert paid(ignore=["line"]) == paid(further="") == 5.0


def test_amounts_keep_all_digits(spark, tmp_path):
    (tmp_path / "t.json").write_text(
        '{"originalamount": 1.004, "extendedamount": 1.0035, "totaldiscount": 1.00004}\n'
        '{"extendedamount": 999999999999999.5}\n'
    )
    found = readers.read_tickets(spark, f"{tmp_path}/t.json")
    assert set(rows_of(found, "originalamount", "extendedamount", "totaldiscount")) == {
        (Decimal("1.004"), Decimal("1.0035"), Decimal("1.00004")),
        (None, Decimal("999999999999999.5"), None),
    }


def test_values_of_other_types(spark, tmp_path):
    path = f"{tmp_path}/t.json"
    (tmp_path / "t.json").write_text('{"customerid": "2", "storeid": 3.0, "quantity": "2"}\n')
    assert rows_of(readers.read_tickets(spark, path), "customerid", "storeid", "quantity") == [(2, 3, 2.0)]
    (tmp_path / "t.json").write_text(
        '{"customerid": 2.5, "storeid": "S1", "extendedamount": 0.12345678901}\n{"storeid": 4}\n'
    )
    for column in ("customerid", "storeid", "extendedamount"):
        with pytest.raises(Exception, match=f"{column} is no"):
            readers.read_tickets(spark, path).select(column).collect()
    loose = readers.read_tickets(spark, path, invalid="null")
    assert sorted(rows_of(loose, "customerid", "storeid", "extendedamount"), key=str) == [
        (None, 4, None), (None, None, None)
    ]
    counts = readers.invalid_values(spark, path)
    assert {k: n for k, n in counts.items() if n} == {"customerid": 1, "storeid": 1, "extendedamount": 1}


def test_all_reports_from_tables_and_from_the_written_dataset(spark, folder, trained, tmp_path):
    tables = RetailTables(
        predictions=readers.read_predictions(spark, f"{folder}/train/all"),
        tickets=readers.read_tickets(spark, f"{folder}/tickets_*.json"),
        customers=frame(spark, schemas.CUSTOMERS, *[(i, 15 + i, "MFU"[i % 3]) for i in range(1, 61)]),
        stores=frame(spark, schemas.STORES, (1, "Vigo"), (2, "Lugo"), (3, None)),
        products=frame(
            spark,
            schemas.PRODUCTS,
            *[(i, "g", f"f{i % 3}", ("A", "B", None)[i % 3], f"a{i}") for i in range(1, 9)],
        ),
        classification=frame(spark, schemas.CLASSIFICATION, ("f0", "YES", "NO"), ("f1", "NO", "YES")),
    )
    jobs.write_reports(spark, tables, str(tmp_path), stage_tickets=True)
    direct = jobs.reports(tables.predictions, tables)
    assert len(direct) == 15
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(direct)
    for name, report in direct.items():
        written = spark.read.parquet(f"{tmp_path}/{name}")
        places = {
            c: F.round(c, 9) if kind == "double" else F.col(c) for c, kind in report.dtypes
        }
        assert rows_of(written.select(list(places.values()))) == rows_of(
            report.select(list(places.values()))
        )
    for name, total in (("vat_share", 100), ("health_share", 100), ("discount_share", 100)):
        sums = spark.read.parquet(f"{tmp_path}/{name}").groupBy("segmento").sum("relative_freq_pct")
        assert all(abs(row[1] - total) < 1e-9 for row in sums.collect())
    source = WrittenDataset(tables.dataset())
    assert source.rows("customerid").count() == tables.rows("customerid").count()


def test_scratch_lies_in_the_shared_folder_and_is_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_folder", lambda _: str(tmp_path / "shared"))
    with storage.Scratch(spark) as scratch:
        assert scratch.table(spark.range(5), "numbers").count() == 5
        assert scratch.folder.startswith(str(tmp_path / "shared"))
        assert list((tmp_path / "shared").glob("run-*/numbers/*.parquet"))
    assert not list((tmp_path / "shared").glob("run-*"))


class _Session:
    """The parts of a session that name the shared folder."""

    def __init__(self, setting=None, context_folder=None, master="yarn"):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self._setting, self._context_folder = setting, context_folder

    def get(self, key, default):
        return self._setting if key == "spark.checkpoint.dir" and self._setting else default

    def getCheckpointDir(self):
        return self._context_folder

    def setCheckpointDir(self, folder):
        self._context_folder = folder


def test_shared_folder_comes_from_the_setting():
    assert storage.shared_folder(_Session("hdfs://host/shared/", "file:/other")) == "hdfs://host/shared"
    assert storage.shared_folder(_Session(None, "hdfs://host/context")) == "hdfs://host/context"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(_Session())
    local = _Session(master="local[2]")
    assert storage.shared_folder(local) == storage.shared_folder(local)
