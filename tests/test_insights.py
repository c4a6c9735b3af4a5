import pytest

from basketry.operators import insights
from basketry.operators.dataset import DATASET_COLUMNS, WrittenDataset
from tests.toys import rows_of

KINDS = {
    "prediction": "int",
    "ticketid": "long",
    "productid": "long",
    "customerid": "long",
    "storeid": "long",
    "originalamount": "decimal(18,2)",
    "extendedamount": "decimal(18,4)",
    "totaldiscount": "decimal(18,4)",
    "quantity": "double",
    "age": "int",
}


def _dataset(spark, *rows):
    """A joined dataset; columns that a row leaves out are null, the segment is best."""
    schema = ", ".join(f"{c} {KINDS.get(c, 'string')}" for c in DATASET_COLUMNS)
    values = [tuple({"segmento": "best", **row}.get(c) for c in DATASET_COLUMNS) for row in rows]
    return WrittenDataset(spark.createDataFrame(values, schema))


PREDICTIONS = "customerid long, segmento string, recency int, frequency long, monetary double"


@pytest.fixture(scope="module")
def predictions(spark):
    return spark.createDataFrame(
        [
            (1, "best", 1, 10, 100.25),
            (2, "best", 3, 20, 199.75),
            (None, "best", 5, None, None),
            (3, "lost", 90, 1, 100.0),
        ],
        PREDICTIONS,
    )


def test_spend_share(predictions):
    assert rows_of(insights.spend_share(predictions)) == [
        ("best", 300.0, 400.0, 0.75),
        ("lost", 100.0, 400.0, 0.25),
    ]


def test_spend_share_of_nothing(spark):
    nothing = spark.createDataFrame([(1, "best", 1, 1, 0.0)], PREDICTIONS)
    assert rows_of(insights.spend_share(nothing)) == [("best", 0.0, 0.0, None)]


def test_customer_share_counts_rows_in_the_total(predictions):
    assert rows_of(insights.customer_share(predictions)) == [
        ("best", 2, 4, 0.5),
        ("lost", 1, 4, 0.25),
    ]


def test_rfm_means(predictions):
    assert rows_of(insights.rfm_means(predictions)) == [
        ("best", 15.0, 150.0, 3.0),
        ("lost", 1.0, 100.0, 90.0),
    ]


def test_age_mean_counts_a_customer_once(spark):
    data = _dataset(
        spark,
        {"customerid": 1, "age": 20, "ticketid": 1},
        {"customerid": 1, "age": 20, "ticketid": 2},
        {"customerid": 2, "age": 40},
        {"customerid": 3},
    )
    assert rows_of(insights.age_mean(data)) == [("best", 30.0)]


def test_gender_share_leaves_unknown_out(spark):
    data = _dataset(
        spark,
        {"customerid": 1, "gender": "M"},
        {"customerid": 1, "gender": "M", "ticketid": 2},
        {"customerid": 2, "gender": "M"},
        {"customerid": 3, "gender": "M"},
        {"customerid": 4, "gender": "F"},
        {"customerid": 5, "gender": "U"},
        {"customerid": 6},
        {"customerid": 7, "gender": "F", "segmento": "lost"},
    )
    assert rows_of(insights.gender_share(data)) == [
        ("best", "Female", 1, 4, 0.25),
        ("best", "Male", 3, 4, 0.75),
        ("lost", "Female", 1, 1, 1.0),
    ]


def _family_rows(counts):
    return [
        {"productid": line, "merchandisefamily": family}
        for family, n in counts.items()
        for line in range(n)
    ]


def test_families_keep_ties_at_the_last_rank(spark):
    counts = {f"f{i:02d}": 20 - i for i in range(9)} | {"x": 5, "y": 5, "z": 1}
    table = insights.family_counts(_dataset(spark, *_family_rows(counts), {"productid": 1}))
    top = rows_of(insights.top_families(table), "rank", "merchandisefamily", "product_count")
    assert len(top) == 11
    assert top[-2:] == [(10, "x", 5), (10, "y", 5)]
    last = rows_of(insights.last_families(table), "rank", "merchandisefamily")
    assert last[:4] == [(1, "z"), (2, "x"), (2, "y"), (4, "f08")]
    assert last[-1] == (10, "f02")


def test_family_counts_skip_null_products(spark):
    data = _dataset(
        spark,
        {"productid": 1, "merchandisefamily": "a"},
        {"productid": 1, "merchandisefamily": "a"},
        {"merchandisefamily": "a"},
    )
    assert rows_of(insights.family_counts(data)) == [("best", "a", 2)]


def test_top_articles(spark):
    counts = {"a": 6, "b": 5, "c": 4, "d": 3, "e": 2, "f": 2, "g": 1}
    rows = [{"article": article} for article, n in counts.items() for _ in range(n)]
    found = rows_of(insights.top_articles(_dataset(spark, *rows, {})), "article", "product_count", "rank")
    assert found == [("a", 6, 1), ("b", 5, 2), ("c", 4, 3), ("d", 3, 4), ("e", 2, 5), ("f", 2, 5)]


def test_products_per_ticket(spark):
    data = _dataset(
        spark,
        {"customerid": 1, "ticketid": 1, "productid": 1, "quantity": 1.0},
        {"customerid": 1, "ticketid": 1, "productid": 1, "quantity": 1.0, "cardtype": "x"},
        {"customerid": 1, "ticketid": 1, "productid": 1, "quantity": 2.0},
        {"customerid": 1, "ticketid": 2, "productid": 2, "quantity": 1.0},
        {"customerid": 2, "ticketid": 3, "productid": 2, "quantity": 1.0},
        {"segmento": "best"},
        {"segmento": "lost"},
    )
    assert rows_of(insights.products_per_ticket(data)) == [("best", 1.25), ("lost", None)]


def test_vat_share(spark):
    line = {"customerid": 1, "ticketid": 1}
    data = _dataset(
        spark,
        {**line, "productid": 1, "vatdescription": "GENERAL"},
        {**line, "productid": 1, "vatdescription": "GENERAL", "quantity": 2.0},
        {**line, "productid": 2, "vatdescription": "REDUCED"},
        {**line, "productid": 3, "vatdescription": "REDUCED"},
        {**line, "productid": 4, "vatdescription": "REDUCED"},
        {**line, "productid": 5},
    )
    assert rows_of(insights.vat_share(data)) == [("best", "GENERAL", 25.0), ("best", "REDUCED", 75.0)]


def test_health_share_by_pair(spark):
    line = {"customerid": 1, "ticketid": 1}
    data = _dataset(
        spark,
        {**line, "productid": 1, "healthy": "YES", "unhealthy": "NO"},
        {**line, "productid": 2, "healthy": "NO", "unhealthy": "YES"},
        {**line, "productid": 3, "healthy": "NO", "unhealthy": "NO"},
        {**line, "productid": 4, "healthy": "NO", "unhealthy": "NO"},
        {**line, "productid": 5, "unhealthy": "NO"},
    )
    assert rows_of(insights.health_share(data)) == [
        ("best", "NO", "NO", 50.0),
        ("best", "NO", "YES", 25.0),
        ("best", "YES", "NO", 25.0),
    ]


def test_discount_share(spark):
    from decimal import Decimal as D

    line = {"customerid": 1, "ticketid": 1}
    data = _dataset(
        spark,
        {**line, "productid": 1, "originalamount": D(10), "extendedamount": D(9)},
        {**line, "productid": 2, "originalamount": D(10), "extendedamount": D(10)},
        {**line, "productid": 3, "originalamount": D(10)},
        {**line, "productid": 4, "extendedamount": D(1)},
        {**line, "productid": 5, "originalamount": D(10), "extendedamount": D(11)},
        {**line, "productid": 5, "originalamount": D(10), "extendedamount": D(8)},
    )
    assert rows_of(insights.discount_share(data)) == [("best", "NO", 50.0), ("best", "YES", 50.0)]


def test_total_spend(spark):
    from decimal import Decimal as D

    data = _dataset(spark, {"extendedamount": D(1_500_000)}, {"extendedamount": D(500_000)}, {})
    assert rows_of(insights.total_spend_millions(data)) == [(2.0,)]
    assert rows_of(insights.total_spend_millions(_dataset(spark, {}))) == [(None,)]


def test_city_customers(spark):
    data = _dataset(
        spark,
        {"customerid": 1, "city": "Vigo"},
        {"customerid": 1, "city": "Vigo", "storeid": 2},
        {"customerid": 2, "city": "Vigo", "segmento": "lost"},
        {"customerid": 2, "city": "Lugo", "segmento": "lost"},
        {"customerid": 3},
    )
    report = insights.city_customers(data)
    assert rows_of(report) == [
        ("Lugo", "lost", 1, 1),
        ("Vigo", "best", 1, 2),
        ("Vigo", "lost", 1, 2),
    ]
    assert [row["total_city"] for row in report.collect()] == [2, 2, 1]


def test_age_gender_bands(spark):
    ages = (17, 18, 34, 35, 49, 50, 64, 65, None)
    people = [
        {"customerid": 10 * i + (gender == "F"), "gender": gender, "age": age}
        for i, age in enumerate(ages)
        for gender in ("M", "F")
    ]
    data = _dataset(spark, *people, {"customerid": 999, "gender": "U", "age": 30}, {"customerid": 998})
    expected = {"Menor de 18": 1, "Entre 18-34": 2, "Entre 35-49": 2, "Entre 50-64": 2, "Mayor de 65": 1}
    found = {(r[1], r[2]): r[3] for r in rows_of(insights.age_gender_bands(data))}
    assert found == {
        **{(band, "F"): n for band, n in expected.items()},
        **{(band, "M"): n for band, n in {**expected, "Mayor de 65": 2}.items()},
    }
    strict = {(r[1], r[2]): r[3] for r in rows_of(insights.age_gender_bands(data, strict_age=True))}
    assert strict["Mayor de 65", "M"] == 1
