"""Intermediate tables in the shared folder of the cluster.

A table that several jobs read is written once as Parquet and read back: the
lineage ends there, a lost executor costs one re-read instead of a recomputation
from the ticket lines, and later passes read only the columns they need.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is absent the checkpoint folder of the context is taken, and
    only a local session gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="basketry-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


class Scratch:
    """Written intermediate tables of one run; ``with`` removes them at the end."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files.delete(path, True)


@contextmanager
def transient_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends. Only for queries whose results
    are written: until then lost files are computed again as ever."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
