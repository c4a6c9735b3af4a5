"""Broadcast behind a measured size, and bounded input of reducing tasks."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BROADCAST_BYTES = 128 * 1024 * 1024
_FIXED_WIDTH = 16
TASK_BYTES = 16 * 1024 * 1024
_TARGET = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of ``df``, from one aggregate over it."""
    fixed = F.lit(_FIXED_WIDTH * len(df.columns))
    texts = [
        F.coalesce(F.octet_length(field.name), F.lit(0))
        for field in df.schema.fields
        if isinstance(field.dataType, T.StringType)
    ]
    width = reduce(lambda total, text: total + text, texts, fixed)
    return df.agg(F.sum(width.cast("long")).alias("bytes")).first()["bytes"] or 0


def broadcast_within(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it measures at most ``limit`` bytes.

    A larger table comes back without a hint: it joins by shuffle, where adaptive
    execution splits the oversized partitions of the fact side.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


@contextmanager
def small_tasks(spark: SparkSession, most: int = TASK_BYTES) -> Iterator[None]:
    """Jobs inside read at most some ``most`` bytes of a shuffle in a task.

    For steps that hold every row of a task in several hash maps, which take many times the
    compressed bytes that adaptive execution counts. Shuffles get as many more partitions as
    tasks are to be smaller; a smaller target of the session stays as it is.
    """
    target = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_TARGET))
    if target <= most:
        yield
        return
    before = {key: spark.conf.get(key, None) for key in (_TARGET, _FIRST)}
    first = int(before[_FIRST] or spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        spark.conf.set(_TARGET, f"{most}b")
        spark.conf.set(_FIRST, str(math.ceil(first * target / most)))
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
