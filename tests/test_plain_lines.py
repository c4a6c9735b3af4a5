"""Plain ticket lines are told without a parser and give what the parser gives."""

from pyspark.sql import functions as F

from basketry import schemas
from basketry.sources import readers

LINE = (
    '{"customerid":5,"storeid":7,"cardtype":"a","datekey":"2001-01-02","ticketid":9,"productid":3,'
    '"extendedamount":1.50,"originalamount":2.25,"totaldiscount":0.1,"quantity":2.0'
)
PLAIN = [
    LINE + "}",
    LINE + ',"line":0}',
    LINE + ',"line":"b c"}',
    LINE.replace('"originalamount":2.25,', "") + "}",
    LINE.replace("1.50", "-0.5") + "}",
]
OTHER = [
    LINE + ',"line":"0"}',
    LINE + ',"line":1.0}',
    LINE + ',"storeid":8}',
    LINE + ',"totaldiscount":0.1}',
    LINE + ',"x":1,"x":1}',
    LINE + ',"y":{"a":1},"x":2}',
    LINE + ', "line":0}',
    LINE.replace("1.50", "1.5e0") + "}",
    LINE.replace("2.0", "-0.0") + "}",
    LINE.replace('"a"', "1.50") + "}",
    LINE.replace('"a"', '"x\\u0041"') + "}",
    LINE.replace('"a"', '"x,y"') + "}",
    LINE.replace('"a"', '"a\\"}"') + "}",
    LINE.replace("5,", '"5",', 1) + "}",
    LINE.replace("2.0", "NaN") + "}",
    "[" + LINE + "}," + LINE + "}]",
    LINE + "}}",
    "{}",
    '{"customerid":5,"customerid":5}',
    "x",
]


def _written(path, lines):
    path.write_text("\n".join(lines))
    return str(path)


def _parsed_calls(spark, monkeypatch, path, plain):
    """Rows with every line taken as plain or not as ``plain`` says."""
    with monkeypatch.context() as patch:
        if not plain:
            patch.setattr(readers, "_plain", lambda *_: F.lit(False))
        found = readers.read_tickets(spark, path, invalid="null")
        return sorted(map(str, found.collect()))


def test_plain_and_parsed_lines_give_equal_rows(spark, tmp_path, monkeypatch):
    path = _written(tmp_path / "lines.json", PLAIN + OTHER)
    fast = _parsed_calls(spark, monkeypatch, path, plain=True)
    assert fast == _parsed_calls(spark, monkeypatch, path, plain=False)
    assert len(fast) == len(PLAIN + OTHER) + 1


def test_plain_lines_are_never_parsed_as_variant(spark, tmp_path, monkeypatch):
    stop = F.raise_error(F.lit("parsed"))
    monkeypatch.setattr(readers, "_parsed", lambda line, *_: F.array(_stopped(stop)))
    found = readers.read_tickets(spark, _written(tmp_path / "lines.json", PLAIN)).collect()
    assert [row["other_fields"] for row in found][:3] == [None, '{"line":0}', '{"line":"b c"}']


def _stopped(stop):
    known = F.struct(*[stop.cast("string").alias(name) for name in schemas.TICKETS.names])
    return F.struct(known.alias("known"), stop.cast("string").alias("other_fields"))
