"""Exact quantiles of several columns by counting ranges of values.

``approxQuantile`` with error 0 keeps every value in its summary and merges the
summaries on the driver. Here each round counts the rows of a fixed number of value
ranges, keeps the range that holds the wanted rank and cuts it anew. Counts are grouped
aggregates: every range has a task of its own to meet in, and what reaches the driver is
one row per range, however many rows or partitions there are. Once few rows compete, their
values are counted one by one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

RANGES = 1024  # ranges that a round cuts the candidates of one rank into
OCTAVE = 4  # ranges of the first round for each power of two
FEW = 65_536  # candidates of all ranks together whose values are counted one by one
_ZERO = 5_000  # more than the OCTAVE-fold exponent of any double
_INFINITE = 2 * _ZERO


@dataclass
class _Target:
    """A rank that is sought among the ``rows`` values from ``low`` to ``high``, counted
    from the first of them."""

    column: str
    rank: int
    rows: int
    low: float
    high: float

    def narrow(self, ranges: list[Row]) -> None:
        """To the range that holds the rank; ``ranges`` in ascending order."""
        for found in ranges:
            if self.rank <= found["rows"]:
                self.rows, self.low, self.high = found["rows"], found["low"], found["high"]
                return
            self.rank -= found["rows"]
        raise ArithmeticError("the table changed while its quantiles were sought")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float]]:
    """The value at rank ``ceil(p * n)`` (at least 1) for each column and probability.

    Same element as ``df.approxQuantile(columns, probabilities, 0.0)``: nulls and NaN
    are skipped, and a column without values gives an empty list. ``df`` is read in
    every round, two for some ten thousand rows and three or four for any number, so it
    should be a written table.
    """
    return exact_quantiles_of(df, {c: list(probabilities) for c in columns})


def exact_quantiles_of(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float]]:
    """:func:`exact_quantiles` with probabilities of its own for each column."""
    if not any(wanted.values()):
        return {c: [] for c in wanted}
    numbers = df.select(*[_number(df, c).alias(c) for c in wanted])
    first = _collected(magnitudes(numbers, list(wanted)), "column")
    targets: dict[tuple[str, float], _Target] = {}
    for c, probabilities in wanted.items():
        ranges = first.get(c, [])
        n = sum(r["rows"] for r in ranges)
        for p in probabilities if n else ():
            target = _Target(c, max(1, math.ceil(p * n)), n, -math.inf, math.inf)
            target.narrow(ranges)
            targets[c, p] = target
    while True:
        open_ = [t for t in targets.values() if t.low < t.high]
        if not open_:
            break
        few = sum(t.rows for t in open_) <= FEW
        counts = _collected((values if few else ranges_of)(numbers, open_), "target")
        for i, target in enumerate(open_):
            target.narrow(counts[i])
    return {c: [targets[c, p].low for p in ps if (c, p) in targets] for c, ps in wanted.items()}


def _collected(counts: DataFrame, key: str) -> dict[str | int, list[Row]]:
    """Ranges with their rows, least and greatest value, ascending, by column or target."""
    found: dict[str | int, list[Row]] = {}
    for row in sorted(counts.collect(), key=lambda r: r["low"]):
        found.setdefault(row[key], []).append(row)
    return found


def _number(df: DataFrame, name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.nanvl(value, F.lit(None).cast("double"))
    return value


def _counted(values: DataFrame, *keys: str) -> DataFrame:
    return values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def magnitudes(numbers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column``, ``range``, ``rows``, ``low``, ``high``: values counted by sign and magnitude,
    at most some 17,000 ranges a column, a few hundred for usual ones."""
    each = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in columns])
    )
    size = F.abs(F.col("value"))
    step = (
        F.when(size == 0, 0)
        .when(size == math.inf, _INFINITE)
        .otherwise(F.floor(F.log2(F.when(size < math.inf, size)) * OCTAVE) + _ZERO)
    )
    rows = numbers.select(each.alias("of")).select("of.*").where("value is not null")
    return _counted(rows.withColumn("range", F.signum("value").cast("int") * step), "column", "range")


def ranges_of(numbers: DataFrame, targets: Sequence[_Target]) -> DataFrame:
    """``target``, ``range``, ``rows``, ``low``, ``high``: the candidates of each target in
    ``RANGES`` equal parts. Its least and its greatest value lie in different parts."""

    def part(t: _Target) -> Column:
        place = (F.col(f"`{t.column}`") - t.low) / (t.high - t.low) * RANGES
        return F.least(F.floor(place), F.lit(RANGES - 1))

    return _counted(_candidates(numbers, targets, part), "target", "range")


def values(numbers: DataFrame, targets: Sequence[_Target]) -> DataFrame:
    """The same with every value in a range of its own, for few candidates."""
    rows = _candidates(numbers, targets, lambda t: F.lit(0).cast("long"))
    return (
        rows.groupBy("target", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("target", "rows", F.col("value").alias("low"), F.col("value").alias("high"))
    )


def _candidates(numbers: DataFrame, targets: Sequence[_Target], part) -> DataFrame:
    """``target``, ``range``, ``value`` of each value between the ends of a target."""
    marks = [
        F.when(
            F.col(f"`{t.column}`").between(t.low, t.high),
            F.struct(F.lit(i).alias("target"), part(t).alias("range"), F.col(f"`{t.column}`").alias("value")),
        )
        for i, t in enumerate(targets)
    ]
    return numbers.select(F.explode(F.array_compact(F.array(*marks))).alias("of")).select("of.*")
