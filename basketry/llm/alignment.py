"""Alignment of two tokenizers' tokens over the same bytes.

Both token streams of a run of documents are ascending lists of byte offsets where tokens
end. They are merged by merge-path partitioning: binary searches along diagonals of the merge
grid, all diagonals at once, cut the merge into pieces of equal work whatever the length of
the documents or tokens. Each piece finds by itself the offsets where both end; an offset whose
two ends fall to neighbouring pieces is stitched where they meet. Between two common
ends lies a group, and its tokens of both sides are linked.

A document leaves its task as one row, with one row for each pair of ids that it holds
linked. Pairs are counted by an aggregate with a map-side step. The counts come back to the
documents in two ways: pairs frequent enough are at most ``FREQUENT`` in any corpus and go out
by broadcast, the rest, none of them frequent, join by shuffle.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.functions.storage import Scratch
from basketry.llm.pieces import _runs, vocabulary
from basketry.llm.tasks import map_arrow, table, texts_of

WORK = 1 << 14  # ends of both sides in one piece of a merge
CHARS = 1 << 19  # characters that are tokenised and merged at once
WIDE = 64  # links of a group above which equal ids are counted before they are paired
SLICE = 1 << 20  # pairs of ids that a task hands over at once
FREQUENT = 1 << 19  # pairs that are broadcast at most
# Fixed value: the pattern by which byte-level vocabularies cut texts.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STEPS = 8  # steps of a count's histogram for each power of two


@dataclass(frozen=True)
class Tokenizers:
    """Contents of both vocabulary files; what they load is made once in each task."""

    a: str
    b: bytes

    @classmethod
    def read(cls, a: str, b: str) -> Tokenizers:
        with open(a, encoding="utf-8") as first, open(b, "rb") as second:
            return cls(first.read(), second.read())

    def __getstate__(self) -> dict:
        return {"a": self.a, "b": self.b}

    @cached_property
    def entries(self) -> dict[str, int]:
        return json.loads(self.a)["model"]["vocab"]

    @cached_property
    def first(self):
        """Encoder of A: its entries as ranks, where that is what the file says.

        Entries numbered in the order of their merges, cut by the byte-level pattern, encode
        alike in both libraries; the one that keeps no offsets is several times faster.
        """
        file = json.loads(self.a)
        model, cut = file["model"], file["pre_tokenizer"] or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ordered = all(self.entries["".join(m)] == 256 + i for i, m in enumerate(merges))
        usual = (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) == ("ByteLevel", False, True)
        plain = not (file["normalizer"] or model.get("dropout") or model.get("ignore_merges"))
        if ordered and usual and plain:
            import tiktoken

            special = {t["id"] for t in file["added_tokens"]}
            ranks = {self.first_bytes[i]: i for i in self.entries.values() if i not in special}
            ranked = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
            return ranked.encode_ordinary
        from tokenizers import Tokenizer

        found = Tokenizer.from_str(self.a)
        found.encode_special_tokens = True
        return lambda text: found.encode(text, add_special_tokens=False).ids

    @cached_property
    def second(self):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_proto=self.b)

    @cached_property
    def first_bytes(self) -> list[bytes]:
        """Bytes of each id of A: its entry, byte-level decoded."""
        of = {char: byte for byte, char in enumerate(_byte_chars())}
        added = {t["content"]: t["id"] for t in json.loads(self.a)["added_tokens"]}
        entries = self.entries | added
        found = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            found[number] = bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode()
        return found

    @cached_property
    def second_bytes(self) -> list[bytes]:
        """Bytes of each id of B: its piece with U+2581 as blank, a byte piece as the byte."""
        model = self.second
        return [
            bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(model.id_to_piece, range(model.get_piece_size())))
        ]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [self.first(" " + t) for t in texts], self.second.encode(texts, num_threads=1)


def _byte_chars() -> list[str]:
    """Characters that stand for the bytes 0 to 255 in byte-level vocabularies: printable
    Latin-1 characters for themselves, the others by U+0100 and following in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    of = {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}
    return [of[b] for b in range(256)]


def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Cuts (i, j) of the merge of two ascending lists into pieces of ``work`` members.

    On the diagonal i + j = d the cut is found by binary search: it takes from ``a``
    what is at most the next of ``b``, so of two equal members that of ``a`` comes first.
    """
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        at = np.where(open_, middle, 0)
        taken = open_ & (a[np.minimum(at, len(a) - 1)] <= b[np.clip(diagonal - at - 1, 0, len(b) - 1)])
        low = np.where(taken, middle + 1, low)
        high = np.where(open_ & ~taken, middle, high)
    return low, diagonal - low


def common_ends(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Indexes into ``a`` and ``b`` of the members that both strictly ascending lists have."""
    cut_a, cut_b = merge_path(a, b, work)
    of_a, of_b = [], []
    for i, i_end, j, j_end in zip(cut_a, cut_a[1:], cut_b, cut_b[1:]):
        # Stitched: this piece's first end of B meets the last end of A of the piece before.
        if j < j_end and i and a[i - 1] == b[j]:
            of_a.append(np.array([i - 1]))
            of_b.append(np.array([j]))
        if i == i_end or j == j_end:
            continue
        own, other = a[i:i_end], b[j:j_end]
        place = np.searchsorted(own, other)
        hit = np.flatnonzero(own[np.minimum(place, len(own) - 1)] == other)
        of_a.append(i + place[hit])
        of_b.append(j + hit)
    none = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(none + of_a), np.concatenate(none + of_b)


def linked_pairs(
    ids_a: np.ndarray, ids_b: np.ndarray, from_a: np.ndarray, from_b: np.ndarray, doc: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``doc``, ``a``, ``b``, ``n``: linked ids of each document with their number of links.

    Group g has the tokens from ``from_a[g]`` and ``from_b[g]`` to those of g + 1.
    """
    size_a, size_b = np.diff(from_a), np.diff(from_b)
    links = size_a * size_b
    usual = links <= WIDE
    each = np.where(usual, links, 0)
    group = np.repeat(np.arange(len(links)), each)
    place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    row, column = np.divmod(place, size_b[group]) if len(group) else (place, place)
    parts = [(doc[group], ids_a[from_a[group] + row], ids_b[from_b[group] + column], np.ones(len(group), np.int64))]
    for g in np.flatnonzero(~usual):
        a, times_a = np.unique(ids_a[from_a[g] : from_a[g + 1]], return_counts=True)
        b, times_b = np.unique(ids_b[from_b[g] : from_b[g + 1]], return_counts=True)
        parts.append(
            (
                np.full(len(a) * len(b), doc[g]),
                np.repeat(a, len(b)),
                np.tile(b, len(a)),
                np.outer(times_a, times_b).ravel(),
            )
        )
    docs, a, b, n = (np.concatenate(column).astype(np.int64) for column in zip(*parts))
    if not len(docs):
        return docs, a, b, n
    width_a, width_b = int(a.max()) + 1, int(b.max()) + 1
    keys, index = np.unique((docs * width_a + a) * width_b + b, return_inverse=True)
    total = np.bincount(index, weights=n).astype(np.int64)
    rest, b = np.divmod(keys, width_b)
    docs, a = np.divmod(rest, width_a)
    return docs, a, b, total


@dataclass
class Aligned:
    """Aligned tokens of some texts; those that either side does not cover have none."""

    counts: dict[str, np.ndarray]
    digests: list[str]
    pairs: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class Aligner:
    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.bytes_a, self.bytes_b = tokenizers.first_bytes, tokenizers.second_bytes
        self.size_a = np.array([len(x) for x in self.bytes_a])
        self.size_b = np.array([len(x) for x in self.bytes_b])
        # Decimal ids with what follows them: within a side, and at the end of a side.
        self.said_a = _names(len(self.bytes_a), ",", "|")
        self.said_b = _names(len(self.bytes_b), ",", ";")

    def align(self, texts: list[bytes]) -> Aligned:
        ids_a, ids_b = self.tokenizers.encode([t.decode(errors="replace") for t in texts])
        for i, text in enumerate(texts):
            whole = b" " + text
            covered = (
                text
                and b"".join(map(self.bytes_a.__getitem__, ids_a[i])) == whole
                and b"".join(map(self.bytes_b.__getitem__, ids_b[i])) == whole
            )
            if not covered:
                ids_a[i], ids_b[i] = [], []
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (ids_a, ids_b))
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (ids_a, ids_b))
        # Texts follow each other, so the end of each is a common end.
        at_a, at_b = common_ends(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]))
        from_a, from_b = np.append(0, at_a + 1), np.append(0, at_b + 1)
        doc = np.searchsorted(np.cumsum(n_a), at_a, side="right")
        sizes = np.diff(from_a) * np.diff(from_b)
        links = np.zeros(len(texts), dtype=np.int64)
        np.add.at(links, doc, sizes)
        counts = {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc, minlength=len(texts)), "n_links": links}
        return Aligned(
            counts,
            self._digests(a, b, from_a, from_b, n_a + n_b),
            linked_pairs(a, b, from_a, from_b, doc),
        )

    def _digests(
        self, a: np.ndarray, b: np.ndarray, from_a: np.ndarray, from_b: np.ndarray, sizes: np.ndarray
    ) -> list[str]:
        """Digest of the groups of each text, written out as ``a1,a2|b1;a3|b2``."""
        last_a, last_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        last_a[from_a[1:] - 1] = 1
        last_b[from_b[1:] - 1] = 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        said = np.empty(len(a) + len(b), dtype=object)
        said[np.arange(len(a)) + from_b[group_a]] = self.said_a[last_a, a]
        said[np.arange(len(b)) + from_a[group_b + 1]] = self.said_b[last_b, b]
        ends = np.cumsum(sizes).tolist()
        found = []
        for low, high in zip([0, *ends], ends):
            whole = "".join(said[low:high].tolist())[:-1]
            found.append(hashlib.sha256(whole.encode()).hexdigest() if whole else "")
        return found


def _names(size: int, within: str, last: str) -> np.ndarray:
    return np.array([[f"{i}{mark}" for i in range(size)] for mark in (within, last)], dtype=object)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def aligned_rows(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """Of each document a row with its counts and digest, and a row for each pair of ids
    ``a``, ``b`` that it holds linked ``n`` times. ``row`` numbers documents across tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        aligner = Aligner(tokenizers)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = texts_of(batch)
            ids = batch.column("doc_id")
            for low, high in _runs([len(t) for t in texts], CHARS):
                found = aligner.align(texts[low:high])
                size = high - low
                none = pa.nulls(size, pa.int32())
                yield {
                    "row": np.arange(row, row + size),
                    "a": none,
                    "b": none,
                    "n": pa.nulls(size, pa.int64()),
                    "doc_id": ids[low:high],
                    **found.counts,
                    "groups_sha256": found.digests,
                }
                doc, a, b, n = found.pairs
                for start in range(0, len(doc), SLICE):
                    part = slice(start, start + SLICE)
                    size_ = len(doc[part])
                    yield {
                        "row": row + doc[part],
                        "a": a[part].astype(np.int32),
                        "b": b[part].astype(np.int32),
                        "n": n[part],
                        "doc_id": pa.nulls(size_, pa.int64()),
                        **{name: pa.nulls(size_, pa.int64()) for name in _COUNTS},
                        "groups_sha256": pa.nulls(size_, pa.string()),
                    }
                row += size

    kinds = f"row long, a int, b int, n long, doc_id long, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string"
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), kinds, run)


def frequent_from(counts: DataFrame, most: int = FREQUENT) -> int:
    """Least count from which on at most ``most`` pairs have it, by one histogram of
    ``STEPS`` steps for each power of two, a table of a bounded number of rows."""
    step = F.floor(F.log2("docs") * STEPS).cast("int")
    histogram = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("docs").alias("least"))
    total, least = 0, 1 << 62
    for row in sorted(histogram.collect(), key=lambda r: -r["step"]):
        total += row["n"]
        if total > most:
            break
        least = row["least"]
    return least


def align_documents(docs: DataFrame, tokenizers: Tokenizers, frequent: int = FREQUENT) -> DataFrame:
    """One row per document with its tokens, groups, links and what its links count.

    A text without tokens (null, empty, or not given back byte by byte by one of the
    tokenizers) has zeros and an empty digest. Rows that repeat are documents of their own. An
    empty table gives an empty one; columns other than ``doc_id`` and ``text`` are not read.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.table(aligned_rows(docs, tokenizers), "aligned")
    links = rows.where("a is not null").select("row", "a", "b", "n")
    counts = scratch.table(links.groupBy("a", "b").agg(F.count("*").alias("docs")), "counts")
    # At most one row per id of A.
    highest = counts.groupBy("a").agg(F.max("docs").alias("highest"))
    ranked = counts.join(F.broadcast(highest), "a")
    best = (F.col("docs") == F.col("highest")).cast("int")
    key = F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")
    ranked = ranked.select(key.alias("pair"), "docs", best.alias("best"))
    least = frequent_from(counts, frequent)
    often = F.broadcast(ranked.where(F.col("docs") >= least))
    held = links.select("row", key.alias("pair"), "n")
    common = held.join(often, "pair")
    rare = held.join(often.select("pair"), "pair", "left_anti").join(ranked.where(F.col("docs") < least), "pair")
    sums = [F.sum(F.col("n") * F.col("best")).alias("n_best"), F.sum(F.col("n") * F.col("docs")).alias("count_sum")]
    scored = common.groupBy("row").agg(*sums).unionByName(rare.groupBy("row").agg(*sums))
    own = ["doc_id", *_COUNTS, "groups_sha256"]
    heads = rows.where("a is null").select("row", *own, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    every = heads.unionByName(scored, allowMissingColumns=True)
    whole = every.groupBy("row").agg(
        *[F.max(c).alias(c) for c in own], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    return whole.select("doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str, a: str | None = None, b: str | None = None) -> DataFrame:
    """All documents, by the public byte-level vocabulary and the public pieces."""
    tokenizers = Tokenizers.read(a or vocabulary("byte_bpe_50k.json"), b or vocabulary("piece_bpe_32k.model"))
    return align_documents(table(spark, sf_dir, "documents"), tokenizers)
