"""Joins of many lines with a dimension whose keys may be hot."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.sizing import BROADCAST_BYTES, measured_bytes

PARTS = 256  # a key with more than a PARTS-th of the lines is split


@dataclass(frozen=True)
class HotKeys:
    """Into how many parts the lines of a key are dealt; keys that are not named, into one.

    Fewer than ``PARTS`` keys can have a larger share than a ``PARTS``-th each, so the list
    is short whatever the table holds. ``missing`` is the number for lines without a key.
    """

    key: str
    parts: dict[object, int]
    missing: int

    def _of(self, key: Column, missing: int) -> Column:
        found = F.lit(1)
        if self.parts:
            entries = F.create_map(*[F.lit(x) for pair in self.parts.items() for x in pair])
            found = F.coalesce(F.try_element_at(entries, key), F.lit(1))
        return F.when(key.isNull(), F.lit(missing)).otherwise(found)

    def dealt(self, lines: DataFrame, name: str) -> DataFrame:
        """Lines with the part that each belongs to, by a hash of all their columns: a task
        that runs again deals them alike."""
        row = F.xxhash64(*[F.col(f"`{c}`") for c in lines.columns])
        return lines.withColumn(name, F.pmod(row, self._of(F.col(self.key), self.missing)).cast("int"))

    def repeated(self, dimension: DataFrame, name: str) -> DataFrame:
        """Dimension rows, once for each part of their key."""
        last = self._of(F.col(self.key), 1) - 1
        return dimension.withColumn(name, F.explode(F.sequence(F.lit(0), last)))


def hot_keys(lines: DataFrame, key: str, parts: int = PARTS) -> HotKeys:
    """Measures the share of each key by a grouped count of the key column alone.

    The share decides how evenly work is dealt, never the result, so ``lines`` may be counted
    before copies are dropped.
    """
    total = lines.select(key).count()
    counts = lines.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    hot = [(row["key"], row["n"]) for row in counts.where(F.col("n") * parts > total).collect()]
    split = {k: math.ceil(n * parts / total) for k, n in hot if k is not None}
    return HotKeys(key, split, next((math.ceil(n * parts / total) for k, n in hot if k is None), 1))


def join_dimension(
    lines: DataFrame,
    dimension: DataFrame,
    key: str,
    counted: DataFrame | None = None,
    limit: int = BROADCAST_BYTES,
    parts: int = PARTS,
) -> DataFrame:
    """Left join of ``lines`` with ``dimension`` on ``key``.

    A dimension that measures at most ``limit`` bytes is broadcast. A larger one joins by
    shuffle on the key and a part: the lines of a hot key are dealt to several parts, and
    its dimension rows go to each of them. Lines without a key, which match nothing, are dealt too.
    ``counted`` (by default the lines) is the table whose keys are measured.
    """
    if measured_bytes(dimension) <= limit:
        return lines.join(F.broadcast(dimension), key, "left")
    hot = hot_keys(lines if counted is None else counted, key, parts)
    part = "_part"
    joined = hot.dealt(lines, part).join(hot.repeated(dimension, part), [key, part], "left")
    return joined.drop(part)
