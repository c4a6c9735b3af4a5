"""Small hand-written tables."""

from decimal import Decimal

from basketry import schemas

_LINE = {
    "customerid": 1,
    "storeid": 1,
    "cardtype": "gold",
    "datekey": "2020-01-01",
    "ticketid": 1,
    "productid": 1,
    "extendedamount": "10",
    "originalamount": "12",
    "totaldiscount": "2",
    "quantity": 1.0,
}


def _money(value):
    return None if value is None else Decimal(value)


def tickets(spark, *lines):
    """Ticket lines; each dict overrides the defaults of one line."""
    rows = []
    for line in lines:
        row = {**_LINE, **line}
        for amount in ("extendedamount", "originalamount", "totaldiscount"):
            row[amount] = _money(row[amount])
        rows.append(tuple(row[name] for name in schemas.TICKETS.names))
    return spark.createDataFrame(rows, schemas.TICKETS)


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows_of(df, *columns):
    """Rows as a sorted list of tuples, nulls last."""
    found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda row: [(v is None, v if v is not None else 0) for v in row])
