"""Small helpers shared by the operators: tables, words, and Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Lower-cases A-Z, keeps 0-9, a-z and every byte of a non-ASCII character, blanks the rest.
_ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANKS = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alnum_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return text.translate(_ALNUM).split()


def blank_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased."""
    return text.translate(_LOWER).split()


def map_arrow(
    df: DataFrame,
    schema: str | StructType,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]],
) -> DataFrame:
    """``mapInArrow`` with a function that yields columns as a dict of lists or arrays."""
    kind = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batches):
            given = [columns[f.name] for f in kind]
            yield pa.RecordBatch.from_arrays(
                [x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, type=f.type) for x, f in zip(given, kind)],
                schema=kind,
            )

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def with_length(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars``, where there is one, set to the length of the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long"))
