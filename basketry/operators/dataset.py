"""Segments joined with tickets, customers, stores, products and classification.

The joined relation is defined as the distinct rows of
``predictions ⟕ tickets ⟕ customers ⟕ stores ⟕ products ⟕ classification``. It is
built in another order, with the same rows:

* Ticket lines are made distinct before the joins. Each joined row carries all columns
  of its line and of its dimension rows, so distinct inputs give distinct output, and
  copies of a line vanish on the map side of the first shuffle.
* Predictions and customers share the customer id, products and classification hang
  together by family. Each pair is joined at its own small size, then the lines
  meet one table per key: customer, store, product.
* The outer join of predictions with tickets is an inner join plus the predictions
  without a ticket. Adaptive execution can split an oversized customer on the ticket
  side of an inner join, which it cannot on the inner side of an outer join.
* Stores and products are broadcast where they measure small enough. Larger ones join by
  shuffle with the lines of hot stores and products dealt to several tasks
  (:mod:`basketry.functions.skew`).

Reports that only count lines or add amounts of products take ``sold`` or ``baskets``:
lines are summed up per segment, store and product right after they met the customers,
so neither the stores nor the products, whose keys are skewed, ever meet single lines.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.sizing import BROADCAST_BYTES, broadcast_within
from basketry.functions.skew import join_dimension

SEGMENT_COLUMNS = ("segmento", "prediction")
LINE_COLUMNS = (
    "ticketid",
    "productid",
    "customerid",
    "storeid",
    "originalamount",
    "extendedamount",
    "quantity",
    "datekey",
    "cardtype",
    "totaldiscount",
)
CUSTOMER_COLUMNS = ("age", "gender")
STORE_COLUMNS = ("city",)
PRODUCT_COLUMNS = ("merchandisegroup", "merchandisefamily", "vatdescription", "article")
CLASS_COLUMNS = ("healthy", "unhealthy")
DATASET_COLUMNS = (
    *SEGMENT_COLUMNS,
    *LINE_COLUMNS,
    *CUSTOMER_COLUMNS,
    *STORE_COLUMNS,
    *PRODUCT_COLUMNS,
    *CLASS_COLUMNS,
)


@dataclass(frozen=True)
class WrittenDataset:
    """The joined relation as a DataFrame that already exists, best as a written table."""

    dataset: DataFrame
    written_baskets: DataFrame | None = None

    def rows(self, *columns: str) -> DataFrame:
        """Every row, cut down to ``columns``."""
        return self.dataset.select(*columns)

    def distinct_rows(self, *columns: str) -> DataFrame:
        """The distinct rows of :meth:`rows`."""
        return self.rows(*columns).distinct()

    def sold(self, *attributes: str) -> DataFrame:
        """``lines`` and ``paid`` of all rows by segment, product and ``attributes``."""
        return self.dataset.groupBy("segmento", "productid", *attributes).agg(*_line_sums())

    def baskets(self) -> DataFrame:
        """``bought``: distinct pairs of customer and ticket by segment and product."""
        if self.written_baskets is not None:
            return self.written_baskets
        return _bought(self.distinct_rows("segmento", "customerid", "ticketid", "productid"))

    def attributes(self, *attributes: str) -> DataFrame:
        """Products with the distinct values of their ``attributes``."""
        return self.distinct_rows("productid", *attributes).where("productid is not null")


@dataclass(frozen=True)
class RetailTables:
    """The six tables, from which the joined relation is derived as far as it is needed.

    ``distinct_tickets`` says that no ticket line of a customer occurs twice, as in a table
    that was written so: its lines then go straight to the first join.
    """

    predictions: DataFrame
    tickets: DataFrame
    customers: DataFrame
    stores: DataFrame
    products: DataFrame
    classification: DataFrame
    broadcast_bytes: int = BROADCAST_BYTES
    distinct_tickets: bool = False

    def dataset(self) -> DataFrame:
        """The whole joined relation."""
        return self.rows(*DATASET_COLUMNS)

    def rows(self, *columns: str) -> DataFrame:
        """Every row of the joined relation, cut down to ``columns``.

        All dimensions take part even if no column of theirs is asked for, because a key
        with several dimension rows multiplies the lines.
        """
        joined = self._lines().join(self._members(SEGMENT_COLUMNS, CUSTOMER_COLUMNS), "customerid")
        # Products are the larger table: if only they are shuffled, no city goes along.
        joined = self._dimension(joined, self._products(PRODUCT_COLUMNS + CLASS_COLUMNS), "productid")
        joined = self._dimension(joined, self._stores(), "storeid")
        return joined.select(*columns).unionByName(
            self._without_tickets(SEGMENT_COLUMNS).select(*self._or_null(columns))
        )

    def distinct_rows(self, *columns: str) -> DataFrame:
        """The distinct rows of the joined relation cut down to ``columns``.

        Only the line columns and dimensions behind ``columns`` are read, and lines are
        reduced to their distinct values before any join.
        """
        segment = _among(columns, SEGMENT_COLUMNS)
        store = _among(columns, STORE_COLUMNS)
        product = _among(columns, PRODUCT_COLUMNS + CLASS_COLUMNS)
        keys = {"customerid"} | ({"storeid"} if store else set()) | ({"productid"} if product else set())
        line = [c for c in LINE_COLUMNS if c in keys or c in columns]

        members = self._members(segment, _among(columns, CUSTOMER_COLUMNS))
        joined = self.tickets.select(*line).distinct().join(members, "customerid")
        if store:
            joined = self._dimension(joined, self._stores(), "storeid")
        if product:
            joined = self._dimension(joined, self._products(product), "productid")
        found = joined.select(*columns).unionByName(
            self._without_tickets(segment or SEGMENT_COLUMNS).select(*self._or_null(columns))
        )
        # Distinct lines and dimensions stay distinct as long as their columns are kept.
        return found if segment and set(line) <= set(columns) else found.distinct()

    def sold(self, *attributes: str) -> DataFrame:
        """``lines`` and ``paid`` of all rows by segment, product and ``attributes``.

        A store or product with several dimension rows repeats the sums as it would have
        repeated the lines. Predictions without a ticket have no lines.
        """
        sums = (F.sum("lines").alias("lines"), F.sum("paid").alias("paid"))
        summed = (
            self._lines()
            .join(self._members(SEGMENT_COLUMNS, CUSTOMER_COLUMNS), "customerid")
            .groupBy("segmento", "storeid", "productid")
            .agg(*_line_sums())
        )
        # A store or product has one row per segment here, or one per segment and other key.
        return (
            summed.join(broadcast_within(self._stores(), self.broadcast_bytes), "storeid", "left")
            .groupBy("segmento", "productid")
            .agg(*sums)
            .join(self.attributes(*PRODUCT_COLUMNS, *CLASS_COLUMNS), "productid", "left")
            .select("segmento", "productid", *attributes, "lines", "paid")
        )

    def baskets(self) -> DataFrame:
        """``bought``: distinct pairs of customer and ticket by segment and product."""
        lines = self.tickets.select("customerid", "ticketid", "productid").distinct()
        return _bought(lines.join(self._members(("segmento",), ()), "customerid"))

    def attributes(self, *attributes: str) -> DataFrame:
        """Products with the distinct values of their ``attributes``."""
        return broadcast_within(self._products(attributes), self.broadcast_bytes)

    def _lines(self) -> DataFrame:
        """The distinct ticket lines."""
        lines = self.tickets.select(*LINE_COLUMNS)
        return lines if self.distinct_tickets else lines.distinct()

    def _dimension(self, lines: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
        return join_dimension(lines, dimension, key, counted=self.tickets, limit=self.broadcast_bytes)

    def _members(self, segment: Iterable[str], attributes: Iterable[str]) -> DataFrame:
        """Predicted customers with ``attributes`` from the customer table.

        Rebalancing detaches the result from the partitioning by customer that its own
        join leaves behind. Both sides of the join with the lines then have a shuffle of
        their own, without which adaptive execution would not split a hot customer; it
        also knows the true size of the members and broadcasts a small table.
        """
        members = self.predictions.select("customerid", *segment).distinct()
        if attributes:
            customers = self.customers.select("customerid", *attributes).distinct()
            members = members.join(customers, "customerid", "left")
        return members.hint("rebalance")

    def _stores(self) -> DataFrame:
        return self.stores.select("storeid", *STORE_COLUMNS).distinct()

    def _products(self, attributes: Iterable[str]) -> DataFrame:
        """Products with ``attributes`` of their own and of their family's class."""
        classes = _among(attributes, CLASS_COLUMNS)
        family = ["merchandisefamily"] if classes else []
        own = dict.fromkeys([*_among(attributes, PRODUCT_COLUMNS), *family])
        products = self.products.select("productid", *own).distinct()
        if classes:
            classification = self.classification.select("merchandisefamily", *classes).distinct()
            products = products.join(classification, "merchandisefamily", "left")
        return products.select("productid", *attributes).distinct()

    def _without_tickets(self, segment: Iterable[str]) -> DataFrame:
        """The segments of predicted customers without a ticket, each once."""
        buyers = self.tickets.select("customerid").distinct()
        return (
            self.predictions.select("customerid", *segment)
            .join(buyers, "customerid", "left_anti")
            .select(*segment)
            .distinct()
        )

    def _or_null(self, columns: Iterable[str]) -> list[Column]:
        """Segment columns as they are, all others as typed nulls."""
        tables = (self.tickets, self.customers, self.stores, self.products, self.classification)
        kinds = {field.name: field.dataType for table in tables for field in table.schema.fields}
        return [
            F.col(c) if c in SEGMENT_COLUMNS else F.lit(None).cast(kinds[c]).alias(c)
            for c in columns
        ]


def _among(columns: Iterable[str], group: Iterable[str]) -> tuple[str, ...]:
    return tuple(c for c in group if c in columns)


def _line_sums() -> tuple[Column, Column]:
    return F.count(F.lit(1)).alias("lines"), F.sum("extendedamount").alias("paid")


def _bought(distinct: DataFrame) -> DataFrame:
    return distinct.groupBy("segmento", "productid").agg(F.count(F.lit(1)).alias("bought"))
