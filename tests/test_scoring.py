from basketry.operators.scoring import score_customers
from tests.toys import rows_of

RFM = "customerid long, recency int, frequency long, monetary double"
QUARTILES = {
    "recency": [66.0, 158.0, 304.0],
    "frequency": [8.0, 10.0, 12.0],
    "monetary": [10.5, 20.5, 30.5],
}


def _scores(spark, *metrics):
    table = spark.createDataFrame([(i, *m) for i, m in enumerate(metrics)], RFM)
    return [row[1] for row in rows_of(score_customers(table, QUARTILES), "customerid", "rfm_score")]


def test_value_at_a_quartile_takes_the_lower_branch(spark):
    assert _scores(spark, (66, 8, 10.5), (158, 10, 20.5), (304, 12, 30.5), (305, 13, 30.6)) == [
        "144",
        "233",
        "322",
        "411",
    ]


def test_two_digit_quartiles_keep_numeric_order(spark):
    assert _scores(spark, (1, 9, 0.0), (1, 11, 0.0)) == ["134", "124"]


def test_null_metrics_fall_through(spark):
    assert _scores(spark, (None, None, None)) == ["144"]


def test_score_types_and_monotony(spark):
    table = spark.createDataFrame([(i, i, i, float(i)) for i in range(0, 400, 3)], RFM)
    scored = score_customers(table, QUARTILES)
    assert dict(scored.dtypes)["r_quartile"] == "int"
    rows = rows_of(scored, "customerid", "r_quartile", "f_quartile", "m_quartile")
    for before, after in zip(rows, rows[1:]):
        assert before[1] <= after[1] and before[2] >= after[2] and before[3] >= after[3]
