"""Token counts of documents in flat token files without an index.

A token file is a sequence of numbers of fixed width, little-endian, in which a reserved
number ends each document. Files are cut into blocks that know nothing of each other. A
task searches its blocks for the separator with numpy and notes where it found the first
and the last, and the lengths in between. A prefix scan over the blocks of a file, first
over runs of blocks and then within each run, numbers the documents and measures those
that cross block ends: from the last separator of any block before to the first here.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketry.functions.storage import Scratch
from basketry.llm.tasks import map_arrow, table, texts_of

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Splitting pattern and end-of-document number of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
WIDTH = 2
BLOCK_BYTES = 1 << 18
RUN = 1024  # blocks that are scanned together


def encoding(ranks: str = RANKS) -> tiktoken.Encoding:
    with open(ranks, "rb") as file:
        pairs = [line.split() for line in file]
    return tiktoken.Encoding(
        "flat",
        pat_str=PATTERN,
        mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
        special_tokens={},
    )


def token_files(docs: DataFrame, ranks: str = RANKS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Flat token files of ``docs``, one per partition, as blocks ``file``, ``block``, ``payload``.

    Blocks end where they are full, not where documents do. Rows with a null ``payload``
    carry the ids of the file's documents in order, ``ids`` from number ``block`` on; only
    the naming of the counts reads them. The file of ranks must be at the same path on
    every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokens, kind = encoding(ranks), f"<u{WIDTH}"
        end = np.array([END], dtype=kind).tobytes()
        file, block, number = TaskContext.get().partitionId(), 0, 0
        left = b""
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            if ids:
                yield {"file": [file], "block": [number], "payload": [None], "ids": [ids]}
                number += len(ids)
            parts = [left]
            for text in texts_of(batch):
                found = tokens.encode_ordinary(text.decode())
                parts += [np.array(found, dtype=kind).tobytes(), end]
            data = b"".join(parts)
            full = len(data) // block_bytes
            for i in range(full):
                part = data[i * block_bytes : (i + 1) * block_bytes]
                yield {"file": [file], "block": [block + i], "payload": [part], "ids": [None]}
            block += full
            left = data[full * block_bytes :]
        if left:
            yield {"file": [file], "block": [block], "payload": [left], "ids": [None]}

    schema = "file long, block long, payload binary, ids array<long>"
    return map_arrow(docs.select("doc_id", "text"), schema, run)


def read_token_files(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of the flat files under ``path``: any store and any names, up to 2 GB each."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    count = F.ceil(F.col("length") / block_bytes)
    blocks = F.when(count > 0, F.sequence(F.lit(0).cast("long"), count - 1))
    return files.withColumn("block", F.explode(blocks)).select(
        F.col("path").alias("file"),
        "block",
        F.expr(f"substring(content, cast(block * {block_bytes} + 1 as int), {block_bytes})").alias("payload"),
    )


def separators(blocks: DataFrame, end: int = END, width: int = WIDTH) -> DataFrame:
    """Per block: ``tokens``, ``ends`` (separators), ``first`` and ``last`` place of one,
    ``inner`` (lengths of the documents that begin and end in the block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            rows = []
            for payload in batch.column("payload").to_pylist():
                if len(payload) % width:
                    raise ValueError("a block ends inside a token")
                found = np.frombuffer(payload, dtype=f"<u{width}")
                at = np.flatnonzero(found == end)
                first, last = (int(at[0]), int(at[-1])) if len(at) else (None, None)
                rows.append((len(found), len(at), first, last, (np.diff(at) - 1).tolist()))
            names = ("tokens", "ends", "first", "last", "inner")
            columns = dict(zip(names, zip(*rows))) if rows else {n: [] for n in names}
            yield {"file": batch.column("file"), "block": batch.column("block"), **columns}

    kind = blocks.schema["file"].dataType.simpleString()
    schema = f"file {kind}, block long, tokens long, ends long, first long, last long, inner array<long>"
    return map_arrow(blocks.select("file", "block", "payload"), schema, run)


def document_lengths(found: DataFrame) -> DataFrame:
    """``file``, ``number`` (of the document in its file), ``n_tokens``, ``closed``.

    Tokens after a file's last separator are a document that is not closed.
    """
    runs = found.withColumn("run", F.floor(F.col("block") / RUN))
    inside = Window.partitionBy("file", "run").orderBy("block")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.withColumn("at", F.coalesce(F.sum("tokens").over(before), F.lit(0))).withColumns(
        {
            "number": F.coalesce(F.sum("ends").over(before), F.lit(0)),
            # Place in the run of the last separator before the block.
            "open": F.max(F.col("at") + F.col("last")).over(before),
        }
    )
    totals = placed.groupBy("file", "run").agg(
        F.sum("tokens").alias("run_tokens"),
        F.sum("ends").alias("run_ends"),
        F.max(F.col("at") + F.col("last")).alias("run_last"),
    )
    over_runs = Window.partitionBy("file").orderBy("run")
    earlier = over_runs.rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn(
        "run_at", F.coalesce(F.sum("run_tokens").over(earlier), F.lit(0))
    ).select(
        F.col("file").alias("r_file"),
        F.col("run").alias("r_run"),
        "run_at",
        F.coalesce(F.sum("run_ends").over(earlier), F.lit(0)).alias("run_number"),
        F.coalesce(F.max(F.col("run_at") + F.col("run_last")).over(earlier), F.lit(-1)).alias("run_open"),
        (F.col("run_at") + F.col("run_tokens")).alias("run_end"),
        F.coalesce(F.col("run_at") + F.col("run_last"), F.lit(-1)).alias("last_here"),
        (F.lead("run").over(over_runs)).isNull().alias("final"),
    )
    joined = placed.join(starts, (F.col("file") == F.col("r_file")) & (F.col("run") == F.col("r_run")))
    crossing = (
        F.col("run_at") + F.col("at") + F.col("first")
        - F.coalesce(F.col("run_at") + F.col("open"), F.col("run_open")) - 1
    )
    ended = joined.where("ends > 0").select(
        "file",
        (F.col("run_number") + F.col("number")).alias("base"),
        F.posexplode(F.concat(F.array(crossing), F.col("inner"))).alias("place", "n_tokens"),
    )
    tails = starts.where("final").select(
        F.col("r_file").alias("file"),
        (F.col("run_end") - 1 - F.greatest("run_open", "last_here")).alias("n_tokens"),
    ).where("n_tokens > 0")
    return ended.select(
        "file", (F.col("base") + F.col("place")).alias("number"), "n_tokens", F.lit(True).alias("closed")
    ).unionByName(
        tails.select("file", F.lit(None).cast("long").alias("number"), "n_tokens", F.lit(False).alias("closed"))
    )


def count_tokens(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``doc_id``, ``n_tokens`` of every row, by writing flat token files and scanning them.

    A null or empty text has no tokens. Repeated rows and null ids get a row each. Columns
    other than ``doc_id`` and ``text`` are not read; an empty table gives an empty one. The
    files are written to the shared folder; the joins and windows see one narrow row per
    block or document.
    """
    scratch = Scratch(docs.sparkSession)
    files = scratch.table(token_files(docs, ranks), "tokens")
    blocks = files.where("payload IS NOT NULL").select("file", "block", "payload")
    lengths = document_lengths(scratch.table(separators(blocks), "separators"))
    names = files.where("payload IS NULL").select(
        F.col("file").alias("n_file"), "block", F.posexplode("ids").alias("place", "doc_id")
    )
    named = names.select("n_file", (F.col("block") + F.col("place")).alias("n_number"), "doc_id")
    return named.join(
        lengths, (F.col("n_file") == F.col("file")) & (F.col("n_number") == F.col("number"))
    ).select("doc_id", "n_tokens")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
