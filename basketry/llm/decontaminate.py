"""Benchmark decontamination with an FM-index per shard of the training texts.

A shard is a run of documents as one sequence of word numbers. Its index has the
Burrows-Wheeler transform in a wavelet matrix, which counts a symbol before a row in one
step per bit of the alphabet, and the text places of sampled rows. A window of benchmark
words is searched backwards, word by word, for all windows at once; the rows that remain
are located by walking to a sampled row. Occurrences become spans of words, which are
merged per document.

Words that no benchmark item has, and the ends of documents, are breaks: no window spans
them. A break ends every comparison of suffixes, so equal documents do not slow sorting.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from basketry.llm.tasks import alnum_words, map_arrow, table, texts_of, with_length

WINDOW = 10
SAMPLING = 8
SHARD_WORDS = 1 << 21
BLOCK_WORDS = 1 << 20
BLOCK = 64  # positions per counter of the wavelet matrix


class Ranks:
    """Bit vector with counters: ones before a place in constant time."""

    def __init__(self, bits: np.ndarray):
        size = len(bits) // BLOCK + 1
        padded = np.zeros(size * BLOCK, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])[:-1]
        self.zeros = len(bits) - int(counts.sum())

    def ones(self, places: np.ndarray) -> np.ndarray:
        at = places >> 6
        mask = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & mask)

    def get(self, places: np.ndarray) -> np.ndarray:
        return (self.words[places >> 6] >> (places & 63).astype(np.uint64)).astype(np.int64) & 1


class WaveletMatrix:
    """Symbols of a sequence, one bit vector per bit from the highest."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels: list[Ranks] = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append(Ranks(ones))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before its place."""
        low, high = np.zeros_like(places), places
        for shift, level in zip(range(len(self.levels) - 1, -1, -1), self.levels):
            one = (symbols >> shift & 1).astype(bool)
            low1, high1 = level.ones(low), level.ones(high)
            low = np.where(one, level.zeros + low1, low - low1)
            high = np.where(one, level.zeros + high1, high - high1)
        return high - low

    def step(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each place, and its occurrences before the place."""
        low, at = np.zeros_like(places), places
        symbols = np.zeros_like(places)
        for level in self.levels:
            one = level.get(at)
            low1, at1 = level.ones(low), level.ones(at)
            low = np.where(one == 1, level.zeros + low1, low - low1)
            at = np.where(one == 1, level.zeros + at1, at - at1)
            symbols = symbols << 1 | one
        return symbols, at - low


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by doubling; each symbol 0 differs from every other and is least."""
    size = len(text)
    breaks = np.flatnonzero(text == 0)
    rank = text + (len(breaks) - 1)
    rank[breaks] = np.arange(len(breaks))
    order = np.argsort(rank, kind="stable")
    width = 1
    unsorted = None
    while True:
        ordered = rank[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = ordered[1:] != ordered[:-1]
        if unsorted is None:
            names = np.flatnonzero(new)[np.cumsum(new) - 1]
            rank = np.empty(size, dtype=np.int64)
            rank[order] = names
            unsorted = np.arange(size)
        alone = new.copy()
        alone[:-1] &= new[1:]
        # ``order`` holds the suffixes still tied; ``unsorted`` their rows.
        order, unsorted = order[~alone], unsorted[~alone]
        if unsorted.size == 0:
            break
        after = rank[np.minimum(order + width, size - 1)]
        # Tied suffixes are equal over ``width`` symbols without a break, so one follows.
        keys = np.lexsort((after, rank[order]))
        order = order[keys]
        first, second = rank[order], after[keys]
        differs = np.ones(len(order), dtype=bool)
        differs[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        names = unsorted[np.flatnonzero(differs)[np.cumsum(differs) - 1]]
        rank[order] = names
        width *= 2
    result = np.empty(size, dtype=np.int64)
    result[rank] = np.arange(size)
    return result


class FMIndex:
    """Index over word numbers 1..; 0 is a break, and the text must end with one."""

    def __init__(self, text: np.ndarray, sampling: int = SAMPLING):
        size = len(text)
        places = suffix_array(text)
        before = text[places - 1]  # of place 0: the last symbol, a break
        top = int(text.max(initial=0))
        self.matrix = WaveletMatrix(before, max(1, top.bit_length()))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.top = top
        # A walk can't cross a break, so rows after one are sampled too.
        sampled = (places % sampling == 0) | (before == 0)
        self.sampled = Ranks(sampled)
        self.places = places[sampled]
        self.size = size

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each window, given right-aligned in a matrix."""
        low = np.zeros(len(windows), dtype=np.int64)
        high = np.full(len(windows), self.size, dtype=np.int64)
        width = windows.shape[1]
        for k in range(width):
            symbols = windows[:, width - 1 - k]
            live = np.flatnonzero((lengths > k) & (high > low))
            known = symbols[live] <= self.top
            high[live[~known]] = low[live[~known]]
            live = live[known]
            c = symbols[live]
            low[live] = self.first[c] + self.matrix.rank(c, low[live])
            high[live] = self.first[c] + self.matrix.rank(c, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text place of each row."""
        found = np.empty(len(rows), dtype=np.int64)
        open_, walked = np.arange(len(rows)), 0
        while len(open_):
            here = self.sampled.get(rows) == 1
            found[open_[here]] = self.places[self.sampled.ones(rows[here])] + walked
            open_, rows = open_[~here], rows[~here]
            symbols, rank = self.matrix.step(rows)
            rows = self.first[symbols] + rank
            walked += 1
        return found


@dataclass(frozen=True)
class Windows:
    """Distinct windows of one block of items: word numbers right-aligned, and their items."""

    numbers: dict[bytes, int]
    rows: np.ndarray
    lengths: np.ndarray
    items: np.ndarray  # item of each (window, item) pair, sorted by window
    item_from: np.ndarray


def windows_of(items: list[tuple[str, bytes]], width: int = WINDOW) -> Windows:
    numbers: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        ids = [numbers.setdefault(w, len(numbers) + 1) for w in alnum_words(text)]
        for i in range(max(1, len(ids) - width + 1) if ids else 0):
            found.setdefault(tuple(ids[i : i + width]), set()).add(item)
    rows = np.zeros((len(found), width), dtype=np.int64)
    for i, window in enumerate(found):
        rows[i, width - len(window) :] = window
    pairs = [sorted(x) for x in found.values()]
    return Windows(
        numbers,
        rows,
        np.fromiter(map(len, found), np.int64, len(found)),
        np.array([x for p in pairs for x in p], dtype=object),
        np.concatenate([[0], np.cumsum(np.fromiter(map(len, pairs), np.int64, len(pairs)))]).astype(np.int64),
    )


def shard_hits(texts: list[list[bytes]], windows: Windows) -> list[tuple[list[tuple[int, int]], list[str]]]:
    """For each document's words: merged spans [start, end) and the items found."""
    results: list = [([], []) for _ in texts]
    if not len(windows.rows):
        return results
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    known = windows.numbers.get
    text = np.zeros(int(offsets[-1]), dtype=np.int64)
    for offset, words in zip(offsets.tolist(), texts):
        text[offset : offset + len(words)] = np.fromiter((known(w, 0) for w in words), np.int64, len(words))
    # A run of breaks is as good as one; ``origin`` leads back.
    use = (text != 0) | np.concatenate([[True], text[:-1] != 0])
    origin = np.flatnonzero(use)
    # The text's last symbol must be a break.
    compact = np.append(text[use], 0)
    index = FMIndex(compact)
    low, high = index.search(windows.rows, windows.lengths)
    count = high - low
    window = np.repeat(np.arange(len(low)), count)
    rows = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    starts = origin[index.locate(rows)] if len(rows) else np.zeros(0, np.int64)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    order = np.lexsort((starts, owner))
    owner, starts, window = owner[order], starts[order], window[order]
    cuts = np.flatnonzero(np.diff(owner, prepend=-1)) if len(owner) else []
    for a, b in zip(cuts, [*cuts[1:], len(owner)]):
        doc = int(owner[a])
        begin = starts[a:b] - offsets[doc]
        end = np.maximum.accumulate(begin + windows.lengths[window[a:b]])
        heads = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
        tails = np.append(heads[1:], len(begin)) - 1
        spans = list(zip(begin[heads].tolist(), end[tails].tolist()))
        items = {
            x
            for w in np.unique(window[a:b]).tolist()
            for x in windows.items[windows.item_from[w] : windows.item_from[w + 1]]
        }
        results[doc] = (spans, sorted(items))
    return results


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of bounded size, one after the other through the driver.

    The benchmark is a stated set of queries; a block of it, never the whole, is held and
    sent to the tasks. A null text has no words; a null id is named ``null``.
    """
    held, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        text = (row["text"] or "").encode()
        held.append((str(row["item_id"]) if row["item_id"] is not None else "null", text))
        size += len(text) // 4
        if size >= block_words:
            yield held
            held, size = [], 0
    if held:
        yield held


def _search(docs: DataFrame, schema: StructType, windows: Windows, output) -> DataFrame:
    """Maps shards of the rows of ``docs`` to ``output(batch, row numbers, words, hits)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts = texts_of(batch)
            low = 0
            while low < len(texts):
                words, size = [], 0
                while low + len(words) < len(texts) and size < SHARD_WORDS:
                    words.append(alnum_words(texts[low + len(words)]))
                    size += len(words[-1])
                hits = shard_hits(words, windows)
                yield output(batch, low, words, hits)
                low += len(words)

    return map_arrow(docs, schema, run)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _one_pass(docs: DataFrame, windows: Windows, carried: StructType) -> DataFrame:
    """Searches one block; spans and items found for earlier blocks are taken over."""
    names = [f.name for f in docs.schema]
    earlier = "d_start" in names

    def output(batch, low, words, hits) -> dict:
        part = batch.slice(low, len(words))
        spans = [h[0] for h in hits]
        items = [h[1] for h in hits]
        if earlier:
            old = zip(*(part.column(c).to_pylist() for c in ("d_start", "d_end", "d_items")))
            for i, (start, end, had) in enumerate(old):
                spans[i] = _merged([*zip(start, end), *spans[i]])
                items[i] = sorted({*had, *items[i]})
        return {
            **{c: part.column(c) for c in names if not c.startswith("d_")},
            "d_words": [len(w) for w in words],
            "d_start": [[s for s, _ in x] for x in spans],
            "d_end": [[e for _, e in x] for x in spans],
            "d_items": items,
        }

    found = StructType.fromDDL("d_words long, d_start array<long>, d_end array<long>, d_items array<string>")
    return _search(docs, StructType([*carried, *found]), windows, output)


def find_contamination(rows: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``rows`` (``text`` and columns whose names don't begin with ``d_``) with the number of
    words, merged spans of hit words (from 0, end exclusive) and items of each text.

    One narrow pass over the texts for each block of the benchmark; the usual benchmark is
    one block. An empty benchmark hits nothing.
    """
    carried = rows.schema
    found = None
    for block in item_blocks(benchmark):
        found = _one_pass(rows if found is None else found, windows_of(block, width), carried)
    if found is None:
        found = _one_pass(rows, windows_of([], width), carried)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` with counts and digest of what the benchmark hits.

    Null and empty texts have no words. Repeated rows are reported each. ``spans`` lists
    ``first word:end word``. Columns other than ``doc_id`` and ``text`` are not read.
    """
    found = find_contamination(docs.select("doc_id", "text"), benchmark, width)
    hit = F.aggregate(
        F.zip_with("d_start", "d_end", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x
    )
    return found.select(
        "doc_id",
        F.col("d_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("d_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("d_items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.array_join(
            F.zip_with("d_start", "d_end", lambda a, b: F.concat_ws(":", a.cast("string"), b.cast("string"))), ","
        ).alias("spans"),
    )


_WORD_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def cut_spans(text: str, starts: list[int], ends: list[int]) -> str:
    """The text without the words of the spans and what stands between them.

    What is left on both sides is joined by a line break if the gap had one, else a blank.
    """
    data = text.encode()
    places = [m.span() for m in _WORD_BYTES.finditer(data)]
    parts, at = [], 0
    for start, end in zip(starts, ends):
        low, high = places[start][0], places[end - 1][1]
        follow = places[end][0] if end < len(places) else len(data)
        parts.append(data[at:low])
        between = data[high:follow]
        parts.append(b"\n" if b"\n" in between else b" " if low > at and follow < len(data) else b"")
        at = follow
    parts.append(data[at:])
    return b"".join(parts).decode()


def without_passages(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` with the hit spans cut out of the texts, in the columns of ``docs``.

    A text without hits stays as it is, a null text too; ``n_chars`` follows the text. A
    narrow map: nothing is shuffled.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("c_row")
    found = find_contamination(docs.select("text", row), benchmark, width)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([cut_spans(t, s, e) if len(s) else t for t, s, e in zip(texts, starts, ends)])

    text = cut("text", "d_start", "d_end")
    cleaned = found.select(
        *[(text if c == "text" else F.col("c_row")[c]).alias(c) for c in docs.columns]
    )
    return with_length(cleaned)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
