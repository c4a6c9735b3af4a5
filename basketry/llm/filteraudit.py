"""Audit of how filters interact, over every order in which they could run.

One pass marks each document with the set of filters that it fails; documents of a part
that fail the same set count together from then on. A mask matrix (0 where the set holds a
filter, no limit elsewhere) and the matrix of the filters' positions in every order (the
inverse permutations) are combined as a min-plus product: the least position of a failed
filter is the step that removes the set. Counts are scattered to (order, step) by weight.

Whether a text repeats one of a smaller id is settled per digest of the text: numbers of
equal rows, least ids and how often the least id comes are sums and minima with a map-side
step, so a text that a third of all rows share is a few rows in the last task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketry.functions.sizing import broadcast_within
from basketry.llm.tasks import map_arrow, table, texts_of

LEAST_WORDS = 200
LEAST_DISTINCT_PCT = 50
MOST_CAPITAL_PCT = 3
FILTERS = "ABCDE"
_MARKS = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(65, 91))
_FOLLOWING = bytes(range(0x80, 0xC0))  # bytes that continue a character
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_RESULT = f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in (*_COUNTS, 'shapley'))}"


def text_failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails, A the lowest."""
    words = text.split()
    points = len(text.translate(None, _FOLLOWING))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT_PCT * len(words)) << 1
        | (100 * capitals > MOST_CAPITAL_PCT * points) << 2
        | (_MARKS.search(text) is not None) << 3
    )


def marked(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``mask`` of A to D and ``digest`` of the text, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = texts_of(batch)
            yield {
                "doc_id": batch.column("doc_id"),
                "part": batch.column("part"),
                "mask": [text_failures(t) for t in texts],
                "digest": [hashlib.sha256(t).digest() for t in texts],
            }

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("lang", F.lit("")).alias("part")
    )
    return map_arrow(rows, "doc_id long, part string, mask int, digest binary", run)


def label_flags(labels: DataFrame) -> DataFrame:
    """``doc_id``, ``good``, ``toxic``: one row per labelled document."""
    flag = lambda name: F.max(F.coalesce((F.col(name) == 1).cast("int"), F.lit(0)))
    named = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return named.agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))


def pattern_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask``, ``good``, ``toxic``, ``n``: documents by the set of filters they fail.

    A row without an id has no smaller id and gives none: it never fails E. Rows that repeat
    an id are documents of their own with equal ids.
    """
    kinds = ["part", "mask", "good", "toxic"]
    flags = broadcast_within(label_flags(labels))
    rows = marked(docs).join(flags, "doc_id", "left").fillna(0, ["good", "toxic"])
    ids = rows.groupBy("digest", "doc_id", *kinds).agg(F.count("*").alias("n"))
    # Of each digest and kind: all rows, those with an id, the least id and its rows.
    named = F.col("doc_id").isNotNull()
    kind = ids.groupBy("digest", *kinds).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(named, F.col("n")).otherwise(0)).alias("named"),
        F.min(F.when(named, F.struct("doc_id", "n"))).alias("own"),
    )
    least = F.min("own.doc_id").over(Window.partitionBy("digest"))
    at_least = F.when(F.col("own.doc_id") == F.col("least"), F.col("own.n")).otherwise(0)
    fails = F.col("named") - at_least
    repeats = 1 << FILTERS.index("E")
    split = kind.withColumn("least", least).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask").bitwiseOR(F.lit(repeats)).alias("mask"), fails.alias("n")),
                F.struct(F.col("mask"), (F.col("n") - fails).alias("n")),
            )
        ).alias("of"),
    )
    return (
        split.select("part", "of.mask", "good", "toxic", "of.n")
        .where("n > 0")
        .groupBy(*kinds)
        .agg(F.sum("n").alias("n"))
    )


def positions(names: str) -> tuple[list[str], np.ndarray]:
    """All orders of the filters, and of each order the position of every filter."""
    orders = list(permutations(range(len(names))))
    return ["".join(names[i] for i in order) for order in orders], np.argsort(orders, axis=1)


def min_plus(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Min-plus product: least ``left[i, k] + right[k, j]`` over k."""
    found = left[:, :1] + right[:1]
    for k in range(1, left.shape[1]):
        np.minimum(found, left[:, k : k + 1] + right[k : k + 1], out=found)
    return found


def interactions(patterns: pd.DataFrame, names: str = FILTERS) -> pd.DataFrame:
    """Counts by order and step of one part, given as ``mask``, ``good``, ``toxic``, ``n``."""
    size = len(names)
    orders, place = positions(names)
    weight = patterns["n"].to_numpy(np.int64)
    mask = patterns["mask"].to_numpy(np.int64)
    fails = (mask[:, None] >> np.arange(size) & 1).astype(bool)
    masks = np.where(fails, 0, size)
    removal = np.minimum(min_plus(masks, place.T), size)  # pattern x order; size: never removed

    def scattered(steps: np.ndarray, weights: np.ndarray) -> np.ndarray:
        found = np.zeros((len(orders), size + 1), dtype=np.int64)
        np.add.at(found, (np.arange(len(orders)), steps), weights[:, None])
        return found[:, :size]

    removed = scattered(removal, weight)
    redundant = np.zeros_like(removed)
    for f in range(size):  # a filter that the set fails, but that comes after the removal
        late = removal[fails[:, f]] < place[:, f]
        redundant[np.arange(len(orders)), place[:, f]] = weight[fails[:, f]] @ late.astype(np.int64)
    alone = np.array([weight[mask == 1 << f].sum() for f in range(size)], dtype=np.int64)
    at = np.argsort(place, axis=1)  # filter of each order and step
    flag = {k: scattered(removal, weight * patterns[k].to_numpy(np.int64)) for k in ("good", "toxic")}
    total = np.zeros(size, dtype=np.int64)
    np.add.at(total, at, removed)
    columns = {
        "kept": weight.sum() - removed.cumsum(axis=1),
        "removed": removed,
        "redundant": redundant,
        "unique_fails": alone[at],
        "good_lost": flag["good"],
        "toxic_lost": flag["toxic"],
        "shapley": total[at],
    }
    found = pd.DataFrame({name: values.ravel() for name, values in columns.items()})
    found.insert(0, "step", np.tile(np.arange(1, size + 1, dtype=np.int32), len(orders)))
    found.insert(0, "filter_order", np.repeat(orders, size))
    return found


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (language, null as empty), order of the five filters and step.

    Zeros are rows too. A null text counts as empty. A document with several labels is good
    or toxic if one of them says so; labels of no document, or without an id, count nowhere.
    An empty table has no parts and so no rows; other columns are not read.
    """

    def of_part(key: tuple, patterns: pd.DataFrame) -> pd.DataFrame:
        found = interactions(patterns)
        found.insert(0, "part", key[0])
        return found

    # At most 2 ** 5 sets x 4 flags a part.
    return pattern_counts(docs, labels).groupBy("part").applyInPandas(of_part, _RESULT)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), flags AS (
  SELECT doc_id, max(coalesce(quality = 1, false)::int) AS good, max(coalesce(toxic = 1, false)::int) AS toxic
  FROM labels GROUP BY doc_id
), failed AS (
  SELECT part,
         len(words) < 200 AS a,
         100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(min(texts.doc_id) OVER (PARTITION BY t) < texts.doc_id, false) AS e,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM texts LEFT JOIN flags ON texts.doc_id = flags.doc_id
), patterns AS (
  SELECT part, a, b, c, d, e, good, toxic, count(*) AS n FROM failed GROUP BY ALL
), f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT f1.f || f2.f || f3.f || f4.f || f5.f AS filter_order
  FROM f f1, f f2, f f3, f f4, f f5
  WHERE f2.f <> f1.f AND f3.f NOT IN (f1.f, f2.f) AND f4.f NOT IN (f1.f, f2.f, f3.f)
    AND f5.f NOT IN (f1.f, f2.f, f3.f, f4.f)
), ranked AS (
  SELECT *, least(if(a, strpos(filter_order, 'A'), 9), if(b, strpos(filter_order, 'B'), 9),
                  if(c, strpos(filter_order, 'C'), 9), if(d, strpos(filter_order, 'D'), 9),
                  if(e, strpos(filter_order, 'E'), 9)) AS gone
  FROM patterns, orders
), steps AS (
  SELECT *, substr(filter_order, step::int, 1) AS letter FROM ranked, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counted AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (gone > step), 0) AS kept,
         coalesce(sum(n) FILTER (gone = step), 0) AS removed,
         coalesce(sum(n) FILTER (gone < step AND fails), 0) AS redundant,
         coalesce(sum(n) FILTER (fails AND a::int + b::int + c::int + d::int + e::int = 1), 0) AS unique_fails,
         coalesce(sum(n * good) FILTER (gone = step), 0) AS good_lost,
         coalesce(sum(n * toxic) FILTER (gone = step), 0) AS toxic_lost
  FROM (SELECT *, CASE letter WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails
        FROM steps)
  GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step::int AS step, kept::bigint AS kept, removed::bigint AS removed,
       redundant::bigint AS redundant, unique_fails::bigint AS unique_fails,
       good_lost::bigint AS good_lost, toxic_lost::bigint AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::bigint AS shapley
FROM counted
"""
