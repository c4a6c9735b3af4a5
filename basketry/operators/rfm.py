"""Recency, frequency and monetary value of each customer, with trimming."""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from basketry.functions.columns import purchase_date
from basketry.functions.quantiles import exact_quantiles, exact_quantiles_of
from basketry.functions.sizing import small_tasks
from basketry.functions.storage import Scratch, transient_shuffles
from basketry.schemas import BOUNDS, THRESHOLDS

METRICS = ("recency", "frequency", "monetary")
QUARTILES = (0.25, 0.5, 0.75)

Bounds = dict[str, float | None]
Thresholds = dict[str, list[float]]


def ticket_lines(tickets: DataFrame) -> DataFrame:
    """Distinct ticket lines rolled up to customer, store, card, date, ticket and product.

    Identical lines are dropped first. Both steps combine on the map side, so copies of
    one line or a very large ticket leave each map task as one row.
    """
    return (
        tickets.dropDuplicates()
        .withColumn("date", purchase_date())
        .groupBy("customerid", "storeid", "cardtype", "date", "ticketid", "productid")
        .agg(
            F.sum("extendedamount").alias("extendedamount"),
            F.sum("originalamount").alias("originalamount"),
            F.sum("totaldiscount").alias("totaldiscount"),
            F.sum("quantity").alias("quantity"),
        )
    )


def written_lines(tickets: DataFrame, scratch: Scratch) -> DataFrame:
    """:func:`ticket_lines` as a written table, reduced in tasks of bounded input.

    Where the tickets come from a join on the ticket, its tasks hold their lines in the maps
    of both steps too, which take some thirty times the bytes of the shuffle."""
    with small_tasks(scratch.spark):
        return scratch.table(ticket_lines(tickets), "lines")


def customer_facts(tickets: DataFrame, distinct: bool = False) -> DataFrame:
    """Last purchase date, distinct tickets and amount paid of each customer.

    The roll-up of :func:`ticket_lines` changes none of the three, so it is left out:
    the distinct lines are aggregated to tickets and then to customers. ``distinct`` says
    that no line occurs twice.
    """
    if distinct:
        lines, amount = tickets.withColumn(DATE, purchase_date()), F.col("extendedamount")
    else:
        lines, amount = narrow_lines(tickets).dropDuplicates(), narrow_amount(tickets, "extendedamount")
    return lines.groupBy("customerid").agg(
        F.max(DATE).alias("last_date"),
        F.count_distinct("ticketid").alias("frequency"),
        F.sum(amount).cast("double").alias("monetary"),
    )


# Amounts of so many digits take 8 bytes in a shuffled row, others 24.
NARROW = T.DecimalType(18, 4)
DATE, ODD_KEY, WIDE = "_date", "_odd_datekey", "_wide"


def _wide_amounts(tickets: DataFrame) -> list[str]:
    """Amounts of types with more digits than 8 bytes hold."""
    kinds = {f.name: f.dataType for f in tickets.schema}
    return [name for name, kind in kinds.items() if isinstance(kind, T.DecimalType) and kind.precision > NARROW.precision]


def narrow_lines(tickets: DataFrame) -> DataFrame:
    """Ticket lines in fewer bytes, two of them equal just where the given ones are.

    The date key becomes its date, and amounts become numbers of 8 bytes. Where the key is not
    the usual text of its date, or an amount of the line does not fit, that key or the
    amounts of the line stay as they are in a column of their own, which is null elsewhere.
    """
    amounts = _wide_amounts(tickets)
    key = F.col("datekey")
    small = {a: F.col(a).try_cast(NARROW) for a in amounts}
    fits = [F.col(a).isNull() | F.coalesce(small[a] == F.col(a), F.lit(False)) for a in amounts]
    lines = tickets.withColumns(
        {DATE: purchase_date(), "_fits": reduce(lambda a, b: a & b, fits, F.lit(True))}
    )
    kept = {ODD_KEY: F.when(~F.col(DATE).cast("string").eqNullSafe(key), key)}
    if amounts:
        kept[WIDE] = F.when(~F.col("_fits"), F.struct(*amounts))
    narrowed = {a: F.when(F.col("_fits"), small[a]) for a in amounts}
    return lines.withColumns(kept | narrowed).drop("datekey", "_fits")


def narrow_amount(tickets: DataFrame, name: str) -> Column:
    """An amount of :func:`narrow_lines` in its type in ``tickets``."""
    if name not in _wide_amounts(tickets):
        return F.col(name)
    return F.coalesce(F.col(name).cast(tickets.schema[name].dataType), F.col(WIDE)[name])


def with_recency(facts: DataFrame, as_of: Column) -> DataFrame:
    """RFM table from customer facts: whole days from the last purchase to ``as_of``."""
    return facts.select(
        "customerid",
        F.datediff(as_of, F.col("last_date")).alias("recency"),
        "frequency",
        "monetary",
    )


@dataclass(frozen=True)
class Batch:
    """What one pass over the tickets found: the RFM table and counts of its customers."""

    table: DataFrame
    last_date: datetime.date | None
    customers: int
    undated: int


def rfm_batch(
    tickets: DataFrame, scratch: Scratch, as_of: datetime.date | None = None, distinct: bool = False
) -> Batch:
    """Reads the tickets once: the write of the customer facts also collects the last date
    of the batch and the counts, as observed metrics of the rows that pass. The shuffle files
    of the lines go with the write."""
    seen = Observation()
    facts = customer_facts(tickets, distinct).observe(
        seen,
        F.max("last_date").alias("last_date"),
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("last_date").isNull()).alias("undated"),
    )
    with small_tasks(scratch.spark), transient_shuffles(scratch.spark):
        written = scratch.table(facts, "facts")
    found = seen.get
    day = found.get("last_date") if as_of is None else as_of
    return Batch(
        with_recency(written, F.lit(day).cast("date")),
        found.get("last_date"),
        found.get("customers", 0),
        found.get("undated", 0),
    )


def rfm(
    tickets: DataFrame, as_of: datetime.date | None = None, distinct: bool = False
) -> DataFrame:
    """RFM table; recency counts from ``as_of``, by default the last date of the batch.

    The last date is known only when all tickets are read, so without ``as_of`` their
    aggregate is written to the shared folder here, and the tickets are not read again.
    """
    if as_of is not None:
        return with_recency(customer_facts(tickets, distinct), F.lit(as_of))
    return rfm_batch(tickets, Scratch(tickets.sparkSession), distinct=distinct).table


def trim_bounds(
    rfm_table: DataFrame,
    r_percentile: float | None = None,
    f_percentile: float | None = None,
    m_percentile: float | None = None,
) -> Bounds:
    """Exact percentile of each metric; a missing or zero percentile sets no bound."""
    given = dict(zip(METRICS, (r_percentile, f_percentile, m_percentile)))
    found = exact_quantiles_of(rfm_table, {m: [p] for m, p in given.items() if p})
    return {m: found[m][0] if found.get(m) else None for m in METRICS}


def bounds_frame(spark: SparkSession, bounds: Bounds) -> DataFrame:
    return spark.createDataFrame([(m, bounds[m]) for m in METRICS], BOUNDS)


def _conditions(bounds: Bounds, inside: bool) -> list[Column]:
    return [
        F.col(m) < F.lit(bounds[m]) if inside else F.col(m) >= F.lit(bounds[m])
        for m in METRICS
        if bounds[m] is not None
    ]


def is_trimmed(bounds: Bounds) -> Column:
    """True for a customer below every bound; null or false keeps the customer out."""
    return reduce(lambda a, b: a & b, _conditions(bounds, inside=True), F.lit(True))


def is_outlier(bounds: Bounds) -> Column:
    """True for a customer at or above any bound."""
    return reduce(lambda a, b: a | b, _conditions(bounds, inside=False), F.lit(False))


def trim(rfm_table: DataFrame, bounds: Bounds) -> DataFrame:
    return rfm_table.where(is_trimmed(bounds))


def outliers(rfm_table: DataFrame, bounds: Bounds) -> DataFrame:
    return rfm_table.where(is_outlier(bounds))


def trim_audit(rfm_table: DataFrame, bounds: Bounds) -> DataFrame:
    """Customer counts in one pass, with those that a null metric scores by default."""
    missing = reduce(lambda a, b: a | b, (F.col(m).isNull() for m in METRICS))
    return rfm_table.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_trimmed(bounds)).alias("trimmed"),
        F.count_if(is_outlier(bounds)).alias("outliers"),
        F.count_if(missing).alias("null_metrics"),
    )


def thresholds(trimmed: DataFrame) -> Thresholds:
    """Exact quartiles of each metric over the trimmed customers."""
    found = exact_quantiles(trimmed, METRICS, QUARTILES)
    empty = [m for m in METRICS if not found[m]]
    if empty:
        raise ValueError(f"no quartiles for {', '.join(empty)}: trimming left no values")
    return found


def thresholds_frame(spark: SparkSession, quartiles: Thresholds) -> DataFrame:
    return spark.createDataFrame([(m, *quartiles[m]) for m in METRICS], THRESHOLDS)
