"""Writers of predictions, thresholds, models and reports. All but the model overwrite."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import StandardScalerModel
from pyspark.mllib.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.functions.columns import SEGMENTS
from basketry.operators.rfm import METRICS, Thresholds, thresholds_frame


def write_predictions(
    predictions: DataFrame,
    path: str,
    fmt: str = "json",
    plain_folders: bool = False,
    compression: str | None = None,
) -> None:
    """All customers under ``all``, and the customers of each segment apart.

    The split lies in ``segments/segmento=<name>``; ``plain_folders`` makes it ``<name>``
    directly under ``path``, with an empty folder for each known segment without customers.
    Either way ``predictions`` are computed once and written by one job: each row leaves it
    for both of its folders. The folders are written under a name of their own and then
    take their places; if one of them cannot, those that were there before come back.
    ``compression`` names a codec of the format, by default the format's own choice.
    """
    spark = predictions.sparkSession
    target = path.rstrip("/")
    work = f"{target}/_writing-{uuid.uuid4().hex}"
    everyone = F.struct(F.lit(ALL).alias("kind"), F.lit(None).cast("string").alias("name"))
    own = F.struct(F.lit(SPLIT).alias("kind"), F.col("segmento").alias("name"))
    folders = F.explode(F.array(everyone, own))
    rows = predictions.select("*", folders.alias("_to")).select(
        *[F.col(f"`{c}`") for c in predictions.columns],
        F.col("_to.kind").alias("_kind"), F.col("_to.name").alias("_name"),
    )
    files = _FileSystem(spark, target)
    try:
        options = {"compression": compression} if compression else {}
        rows.write.partitionBy("_kind", "_name").format(fmt).options(**options).save(work)
        moves = _moves(files, work, target, plain_folders)
        files.replace(moves, f"{work}/old")
    finally:
        files.delete(work)


ALL, SPLIT = "all", "split"


def _moves(files: _FileSystem, work: str, target: str, plain_folders: bool) -> list[tuple[str, str]]:
    """New folder and its place, for every folder of a layout. Spark writes ``_name=`` and the
    escaped name; no name is that of rows for all."""
    everyone = f"{work}/_kind={ALL}/_name=__HIVE_DEFAULT_PARTITION__"
    found = {name.removeprefix("_name="): f"{work}/_kind={SPLIT}/{name}" for name in files.names(f"{work}/_kind={SPLIT}")}
    moves = [(files.made(everyone), f"{target}/all")]
    if plain_folders:
        for name in {**SEGMENTS, **found}:
            moves.append((found.get(name) or files.made(f"{work}/empty/{name}"), f"{target}/{name}"))
    else:
        split = files.made(f"{work}/segments")
        for name, folder in found.items():
            files.move(folder, f"{split}/segmento={name}")
        moves.append((split, f"{target}/segments"))
    for folder, _ in moves:
        files.mark(folder)
    return moves


class _FileSystem:
    """Folders of the file system that a path lies in, through the classes of Hadoop."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, path: str) -> list[str]:
        if not self._files.exists(self._path(path)):
            return []
        return [status.getPath().getName() for status in self._files.listStatus(self._path(path))]

    def made(self, path: str) -> str:
        """The folder, made if it is not there."""
        self._files.mkdirs(self._path(path))
        return path

    def mark(self, path: str) -> None:
        self._files.create(self._path(f"{path}/_SUCCESS"), True).close()

    def move(self, source: str, place: str) -> None:
        if not self._files.rename(self._path(source), self._path(place)):
            raise OSError(f"{source} cannot be moved to {place}")

    def replace(self, moves: list[tuple[str, str]], old: str) -> None:
        """Moves folders to their places; all of them, or none and the old ones stay."""
        self.made(old)
        undo: list[tuple[str, str]] = []
        try:
            for number, (folder, place) in enumerate(moves):
                if self._files.exists(self._path(place)):
                    self.move(place, f"{old}/{number}")
                    undo.append((f"{old}/{number}", place))
                self.move(folder, place)
                undo.append((place, folder))
        except Exception:
            for now, before in reversed(undo):
                self.move(now, before)
            raise

    def delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)


def write_thresholds(spark: SparkSession, quartiles: Thresholds, path: str) -> None:
    """One Parquet table of doubles."""
    thresholds_frame(spark, quartiles).coalesce(1).write.mode("overwrite").parquet(path)


def write_threshold_folders(spark: SparkSession, quartiles: Thresholds, path: str) -> None:
    """Three CSV folders without headers, one number on each line."""
    for m in METRICS:
        numbers = spark.createDataFrame([(q,) for q in quartiles[m]], "q double")
        numbers.coalesce(1).write.mode("overwrite").csv(f"{path}/{m[0]}_quartile")


def require_free(spark: SparkSession, path: str) -> None:
    """Fails before a long job does, as a model is never written over another."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        raise FileExistsError(f"{path} exists; a model needs a path of its own")


def write_model(spark: SparkSession, model: KMeansModel, path: str) -> None:
    model.save(spark.sparkContext, path)


def write_scaler(scaler: StandardScalerModel, path: str) -> None:
    scaler.write().overwrite().save(path)


def write_report(report: DataFrame, path: str, fmt: str = "parquet") -> None:
    report.write.mode("overwrite").format(fmt).save(path)
