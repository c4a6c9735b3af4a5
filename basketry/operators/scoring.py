"""Scores 1 (best) to 4 (worst) of each customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.columns import score
from basketry.operators.rfm import Thresholds

SCORES = ("r_quartile", "f_quartile", "m_quartile")


def score_customers(rfm_table: DataFrame, quartiles: Thresholds) -> DataFrame:
    """Adds the three scores and their digits as ``rfm_score``. Outliers are scored too."""
    return rfm_table.withColumns(
        {
            "r_quartile": score("recency", quartiles["recency"], ascending=True),
            "f_quartile": score("frequency", quartiles["frequency"], ascending=False),
            "m_quartile": score("monetary", quartiles["monetary"], ascending=False),
        }
    ).withColumn("rfm_score", F.concat(*[F.col(s).cast("string") for s in SCORES]))
