"""Corpus pipeline: stages that each read what the one before has written.

Quality rules reject documents, near-duplicate lines and documents go, benchmark passages
are cut out, and what is left is repeated to the target weights of its sources. Every
stage takes the documents that its predecessor kept; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.functions.storage import Scratch
from basketry.llm import decontaminate, linededup, mixing, quality, simhash
from basketry.llm.tasks import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has, alike or nearly so."""
    return linededup.without_duplicate_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that the benchmark holds."""
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in random order."""
    return mixing.mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mix),
]

# Robust estimates, union-find and fingerprints have no SQL form; tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.table(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
