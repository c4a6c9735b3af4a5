"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A document becomes a vector of statistics of its text. Cosines of random projections
approximate a Gaussian kernel over the standardised vector; each partition of labelled
rows adds up its part of the normal equations, the parts are summed in Spark in rows of
the matrix, and one solve gives the weights. Out-of-fold scores are calibrated by isotonic
regression over counts per score level. Scoring is a narrow map over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.functions.storage import Scratch
from basketry.llm.tasks import map_arrow, table, texts_of

CUT = 0.7


@dataclass(frozen=True)
class Settings:
    """``features``: cosines; ``width``: of the kernel, in standard deviations over all
    statistics; ``ridge``: relative to the rows; ``folds`` for the calibration; ``levels``
    of the raw score that are told apart; ``seed`` of the projections."""

    features: int = 256
    width: float = 1.0
    ridge: float = 1e-4
    folds: int = 3
    levels: int = 2048
    seed: int = 7


_CLASSES = np.zeros(256, dtype=np.int64)
for _kind, _bytes in enumerate(
    (b" \t\x0b\x0c\r", b"\n", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
     b"0123456789", b".,;:", b"!?", b"#*$%&|<>", b"'\"()-_/\\@+=[]{}~^`"), 1
):
    _CLASSES[list(_bytes)] = _kind
_KINDS = 10  # with 0 for all other bytes, those of other scripts among them
STATISTICS = _KINDS + 8


def statistics(text: bytes) -> list[float]:
    """Shares and lengths that describe a text; defined for the empty text as well."""
    size = len(text) + 20
    counts = np.bincount(_CLASSES[np.frombuffer(text, dtype=np.uint8)], minlength=_KINDS)
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = set(zip(words, words[1:]))
    lengths = np.fromiter(map(len, words), np.int64, n)
    return [
        *np.sqrt(counts / size).tolist(),
        float(np.log1p(n)),
        float((lengths.sum() + 50) / (n + 10)),
        float(lengths.std()) if n else 0.0,
        (len(set(words)) + 10) / (n + 10),
        (len(pairs) + 10) / (max(n - 1, 0) + 10),
        (len(set(lines)) + 3) / (len(lines) + 3),
        float(np.log1p(len(text) / (len(lines) + 1))),
        float(np.log1p(lengths.max())) if n else 0.0,
    ]


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    spread: np.ndarray
    projections: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores
    values: np.ndarray  # calibrated, never falling

    def features(self, x: np.ndarray) -> np.ndarray:
        # Far outliers saturate instead of wrapping round the cosines.
        z = np.tanh((x - self.centre) / self.spread / 4) * 4
        found = np.cos(z @ self.projections + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([found, np.ones(len(x))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.features(x) @ self.weights, self.knots, self.values)


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``stats`` of every row, null text as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield {
                "doc_id": batch.column("doc_id"),
                "stats": [statistics(t) for t in texts_of(batch)],
            }

    return map_arrow(docs.select("doc_id", "text"), "doc_id long, stats array<double>", run)


def held_out() -> F.Column:
    """Rows no label is learnt from: crc32 of the id as text, modulo 4, is 2."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(key) % 4 == 2


def _fold(folds: int) -> F.Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(folds)).cast("int")


def _equations(rows: DataFrame, model: Model, folds: int) -> np.ndarray:
    """Normal equations per fold: array of (fold, row, column), targets in the last column.

    A task sums its rows and gives one line per fold and matrix row; the lines are summed
    by Spark, so the driver gets matrices whose size depends on the settings alone.
    """
    size = len(model.phases) + 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            x = model.features(np.stack(frame["stats"].to_numpy()))
            y = frame["quality"].to_numpy(dtype=np.float64)
            for fold in np.unique(frame["fold"].to_numpy()):
                own = (frame["fold"] == fold).to_numpy()
                part = x[own].T @ np.column_stack([x[own], y[own]])
                sums[int(fold)] = sums.get(int(fold), 0) + part
        for fold, part in sums.items():
            yield pd.DataFrame(
                {
                    "fold": fold,
                    "row": np.arange(size),
                    "parts": list(part),
                }
            )

    summed = (
        rows.mapInPandas(run, "fold int, row int, parts array<double>")
        .repartition("fold", "row")
        .select("fold", "row", F.posexplode("parts").alias("col", "value"))
        .groupBy("fold", "row", "col")
        .agg(F.sum("value").alias("value"))
    ).toPandas()
    found = np.zeros((folds, size, size + 1))
    found[summed["fold"], summed["row"], summed["col"]] = summed["value"]
    return found


def _solve(equations: np.ndarray, ridge: float) -> np.ndarray:
    size = len(equations)
    rows = max(equations[-1, size - 1], 1.0)  # the last feature is the constant 1
    penalty = np.full(size, ridge * rows)
    penalty[-1] = 1e-9 * rows
    return np.linalg.solve(equations[:, :size] + np.diag(penalty), equations[:, size])


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted least-squares fit that never falls (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for value, weight in zip(values.tolist(), weights.tolist()):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u, x, m = blocks.pop()
            blocks.append([(v * w + u * x) / (w + x), w + x, n + m])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Model from rows ``doc_id``, ``stats``, ``quality`` (0 or 1).

    Without rows every score is 0.5; with one label only, its value. Rows with a null
    label are left out.
    """
    rows = labelled.where("quality IN (0, 1)").withColumn("fold", _fold(settings.folds))
    moments = rows.agg(
        F.count("*"),
        F.avg("quality"),
        *[F.avg(F.col("stats")[i]) for i in range(STATISTICS)],
        *[F.stddev_pop(F.col("stats")[i]) for i in range(STATISTICS)],
    ).first()
    random = np.random.default_rng(settings.seed)
    size = settings.features
    centre = np.array([x or 0.0 for x in moments[2 : 2 + STATISTICS]])
    spread = np.array([x or 0.0 for x in moments[2 + STATISTICS :]])
    scale = settings.width * np.sqrt(STATISTICS)
    plain = Model(
        centre,
        np.where(spread > 1e-9, spread, 1.0),
        random.normal(size=(STATISTICS, size)) / scale,
        random.uniform(0, 2 * np.pi, size),
        np.zeros(size + 1),
        np.zeros(1),
        np.full(1, 0.5 if moments[1] is None else moments[1]),
    )
    if not moments[0]:
        return plain
    parts = _equations(rows, plain, settings.folds)
    total = parts.sum(axis=0)
    outside = [_solve(total - part, settings.ridge) for part in parts]
    knots, values = _calibration(rows, plain, np.stack(outside), settings)
    weights = _solve(total, settings.ridge)
    return Model(plain.centre, plain.spread, plain.projections, plain.phases, weights, knots, values)


def _calibration(rows: DataFrame, model: Model, weights: np.ndarray, settings: Settings):
    """Knots of the calibration from scores by the model that has not seen the row's fold.

    Scores from -0.5 to 1.5 fall on ``levels`` levels; the driver gets counts per level.
    """
    levels = settings.levels

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = model.features(np.stack(frame["stats"].to_numpy()))
            raw = np.einsum("ij,ij->i", x, weights[frame["fold"].to_numpy()])
            level = np.clip(np.floor((raw + 0.5) / 2 * levels), 0, levels - 1).astype(np.int64)
            yield pd.DataFrame({"level": level, "quality": frame["quality"].astype("int64")})

    counts = (
        rows.mapInPandas(run, "level long, quality long")
        .groupBy("level")
        .agg(F.count("*").alias("n"), F.sum("quality").alias("good"))
        .orderBy("level")
        .toPandas()
    )
    n = counts["n"].to_numpy(dtype=np.float64)
    fitted = isotonic(counts["good"].to_numpy() / n, n)
    return (counts["level"].to_numpy() + 0.5) / levels * 2 - 0.5, fitted


def score(measured: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of rows ``doc_id``, ``stats``."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                found = model.score(np.stack(frame["stats"].to_numpy()))
                yield frame[["doc_id"]].assign(score=np.clip(found, 0.0, 1.0))

    scored = measured.mapInPandas(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.round("score", 9).alias("score"),
        (F.round("score", 9) >= cut).cast("int").alias("predicted"),
    )


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Learns from ``labels`` (``doc_id``, ``quality``) and scores every row of ``docs``.

    Only the text enters a score. Held-out rows teach nothing, neither label nor scaling.
    Null and empty texts are scored as the empty text; repeated rows get a row each; labels
    without a document, and null labels, are not used. An empty table gives an empty one.
    The texts are read once; their statistics are written to the shared folder.
    """
    scratch = Scratch(docs.sparkSession)
    measured = scratch.table(with_statistics(docs), "statistics")
    marks = labels.select("doc_id", "quality").where("quality IS NOT NULL").where(~held_out())
    labelled = scratch.table(measured.join(marks, "doc_id"), "labelled")
    return score(measured, fit(labelled, settings))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
