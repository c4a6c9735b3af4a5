"""Fuzzy line deduplication by MinHash.

Lines are compared as sets of character shingles of their normal form. Equal normal forms
are one node from the start; short lines take part as such nodes alone. Signatures of the nodes are cut into bands; nodes that share
a band are candidates, and a candidate link counts only if the exact Jaccard similarity of
the shingle sets reaches the threshold. Distributed union-find joins the links, and of
each component only the first line of the first document stays.

Lines are read and signatures computed in one pass and written. Bands travel without text, packed
by bucket, each with its node and a mark: two bits of each of the signature's bins. Most bands are shared
by chance, the more the larger the table, so nodes of a band whose marks disagree part where
bands meet; what holds together goes on, once for each set of nodes. A set of more than
``BLOCK`` nodes is cut into blocks and every pair of blocks meets in a task of its own: nothing
is skipped, no task holds more than two blocks, and tasks report spanning forests, not pairs.
Sets then meet as sketches, four bits of each of the signature's bins, and fall apart where
fewer than ``AGREE`` bins agree; texts are fetched only for what holds together. Similarity 0.8
makes 45 of the 56 bins agree, with a deviation of 3, so links of 0.8 lie six deviations above.
Bins that agree in four bits agree in two: marks, held against the same bound, part nothing that
sketches leave together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.functions.sizing import broadcast_within
from basketry.functions.storage import Scratch, transient_shuffles
from basketry.llm.components import connected_components
from basketry.llm.tasks import map_arrow, table, texts_of, with_length

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 14
ROWS = 4
LEAST_CHARS = 10
BLOCK = 4096
AGREE = BANDS * ROWS // 2
FEW = 64  # nodes of a set that is compared together with others
WINDOW_BITS = 40  # five characters of a byte each
WITHIN = 2  # side of the nodes of a block that meets itself
SKETCH = [f"sketch_{k}" for k in range(-(-BANDS * ROWS // 16))]
MARK = BANDS * ROWS // 4  # bytes of two bits of each bin
SLICE = 1 << 16  # rows that a task hands over at once, or holds of one band
BAND = 6  # bytes that are written of a band
BUCKETS = 1 << 12  # of bands, by their highest bits
CHARS = 1 << 16  # bytes of lines whose signatures are computed at once

# Lower-cases A-Z and blanks ASCII other than letters and digits.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
# The same, but keeps line breaks.
_FOLD_LINES = _FOLD[:10] + b"\n" + _FOLD[11:]
_PRIME = np.uint64(0x9E3779B97F4A7C15)
# Bins that an empty bin asks in turn: some at random, then every other one.
_PROBES = np.concatenate(
    [
        np.random.default_rng(11).integers(0, BANDS * ROWS, size=(64, BANDS * ROWS)),
        (np.arange(BANDS * ROWS) + np.arange(1, BANDS * ROWS)[:, None]) % (BANDS * ROWS),
    ]
)
_NONE = np.iinfo(np.uint64).max
# A band within its bucket, a node that has it and the node's mark.
_ENTRY = np.dtype([("band", "<u4"), ("node", "<i8"), ("mark", "u1", (MARK,))])
# Odd factors that join two windows of one width to one of twice the width.
_FACTORS = {
    1: np.uint64(0xC2B2AE3D27D4EB4F),
    2: np.uint64(0x165667B19E3779F9),
    4: np.uint64(0x27D4EB2F165667C5),
}


def normal_form(line: bytes) -> bytes:
    """Lower-case A-Z, one blank for each run of blanks and ASCII marks."""
    return b" ".join(line.translate(_FOLD).split())


def node_of(form: bytes) -> int:
    """Signed 64-bit number of a normal form."""
    value = xxhash.xxh3_64_intdigest(form)
    return value - (1 << 64) if value >> 63 else value


def shingles(form: str, size: int = SHINGLE) -> frozenset[str]:
    """Windows of ``size`` characters; a shorter line is one window."""
    return frozenset([form[i : i + size] for i in range(max(1, len(form) - size + 1))])


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    found = (a * _PRIME + b) * _PRIME
    found ^= found >> np.uint64(29)
    return found


def _window_hashes(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``SHINGLE`` characters in the joined lines, sizes of the lines."""
    whole = b"".join(lines)
    if whole.isascii():
        points = np.frombuffer(whole, np.uint8).astype(np.uint64)
        sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    else:
        points = np.frombuffer(whole.decode().encode("utf-32-le"), "<u4").astype(np.uint64)
        leading = (np.frombuffer(whole, np.uint8) & 0xC0) != 0x80  # bytes that begin a character
        starts = np.cumsum([0, *map(len, lines[:-1])])
        sizes = np.add.reduceat(leading, starts, dtype=np.int64)
    width = 1
    while width < SHINGLE:  # windows of 1, 2, 4, 5 characters from two that touch or overlap
        step = min(width, SHINGLE - width)
        points = points[:-step] * _FACTORS[width] + points[step:]
        width += step
    points ^= points >> np.uint64(32)
    points *= _PRIME
    points ^= points >> np.uint64(29)
    points *= _PRIME
    return points, sizes


def _signatures(forms: list[bytes]) -> np.ndarray:
    bins = BANDS * ROWS
    # A line shorter than a shingle is filled up and so becomes one window.
    lines = [f if len(f) >= 4 * SHINGLE else f + b"\0" * (SHINGLE - len(f.decode())) for f in forms]
    hashes, sizes = _window_hashes(lines)
    place = np.repeat(np.arange(len(lines)) * bins, sizes)[: len(hashes)]
    place += ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    crossing = np.cumsum(sizes)[:-1, None] - np.arange(1, SHINGLE)  # windows over two lines
    hashes[crossing.ravel()] = _NONE
    own = np.full(len(lines) * bins, _NONE, dtype=np.uint64)
    np.minimum.at(own, place, hashes)
    own = own.reshape(-1, bins)
    least = own.copy()
    rows, empty = np.nonzero(own == _NONE)
    for probe in _PROBES:
        if not len(rows):
            break
        found = own[rows, probe[empty]]
        least[rows, empty] = found
        still = found == _NONE
        rows, empty = rows[still], empty[still]
    return least


def signatures(forms: list[bytes]) -> np.ndarray:
    """MinHash by one permutation: least hash of a line's shingles in each of
    ``BANDS * ROWS`` bins; an empty bin takes the value of the first filled bin it asks."""
    found, low = [np.zeros((0, BANDS * ROWS), dtype=np.uint64)], 0
    while low < len(forms):
        high, size = low, 0
        while high < len(forms) and size < CHARS:
            size += len(forms[high])
            high += 1
        found.append(_signatures(forms[low:high]))
        low = high
    return np.concatenate(found)


def bands(found: np.ndarray) -> np.ndarray:
    """For each signature one number per band, the band's place mixed in."""
    parts = found.reshape(-1, BANDS, ROWS)
    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(found), 1))
    for row in range(ROWS):
        keys = _mixed(keys, parts[:, :, row])
    return keys.view(np.int64)


def packed_bands(found: np.ndarray) -> list[bytes]:
    """The highest ``BAND`` bytes of each of a signature's bands."""
    keys = bands(found).view(np.uint8).reshape(len(found), BANDS, 8)[:, :, 8 - BAND :]
    return np.ascontiguousarray(keys).reshape(len(found), BANDS * BAND).view(f"V{BANDS * BAND}").ravel().tolist()


def sketches(found: np.ndarray) -> np.ndarray:
    """Low four bits of each bin of the signatures, sixteen bins to a number."""
    bits = np.zeros((len(found), 16 * len(SKETCH)), dtype=np.uint64)
    bits[:, : BANDS * ROWS] = found & np.uint64(15)
    bits <<= np.tile(np.arange(0, 64, 4, dtype=np.uint64), len(SKETCH))
    return np.bitwise_or.reduce(bits.reshape(len(found), len(SKETCH), 16), axis=2).view(np.int64)


def agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of bins in which the sketches of two tables agree, row by row."""
    other = (a ^ b).view(np.uint64)
    other |= other >> np.uint64(2)
    other |= other >> np.uint64(1)
    other &= np.uint64(0x1111111111111111)
    return BANDS * ROWS - np.bitwise_count(other).sum(axis=1, dtype=np.int64)


def marks(short: np.ndarray) -> np.ndarray:
    """Low two bits of each bin of :func:`sketches`, four bins to a byte."""
    pairs = np.ascontiguousarray(short).view(np.uint8)[:, : 2 * MARK] & np.uint8(0x33)
    return pairs[:, :MARK] | pairs[:, MARK:] << np.uint8(2)


def agreeing_marks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of bins in which the marks of two tables agree; marks as whole numbers of 64 bits."""
    other = a ^ b
    other |= other >> np.uint64(1)
    other &= np.uint64(0x5555555555555555)
    return BANDS * ROWS - np.bitwise_count(other).sum(axis=1, dtype=np.int64)


def long_enough(form: bytes) -> bool:
    if form.startswith(b"\0"):
        return False
    return len(form) >= LEAST_CHARS and (form.isascii() or len(form.decode()) >= LEAST_CHARS)


def shingle_numbers(form: bytes) -> np.ndarray:
    """:func:`shingles` of a line in Latin-1, ascending: five bytes are one number, so
    different shingles are different numbers. A shorter line is filled with zero bytes."""
    form = form.ljust(SHINGLE, b"\0")
    eights = np.ndarray(len(form) - SHINGLE + 1, "<u8", form + b"\0" * (8 - SHINGLE), strides=(1,))
    found = np.sort(eights & np.uint64((1 << 8 * SHINGLE) - 1))
    fresh = np.ones(len(found), dtype=bool)
    np.not_equal(found[1:], found[:-1], out=fresh[1:])
    return found[fresh]


def shingle_sets(forms: list[str]) -> list[np.ndarray] | list[frozenset]:
    """Shingles of lines that are to be compared, as numbers where all lines allow it."""
    try:
        return [shingle_numbers(form.encode("latin-1")) for form in forms]
    except UnicodeEncodeError:
        return [shingles(form) for form in forms]


def jaccard(a: frozenset | np.ndarray, b: frozenset | np.ndarray) -> float:
    if isinstance(a, frozenset):
        common = len(a & b)
    else:
        both = np.sort(np.concatenate([a, b]))
        common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common / (len(a) + len(b) - common)


def _masks(sets: list[np.ndarray]) -> np.ndarray:
    """512 bits of each set of numbers: those that the hashes of its members name."""
    bits = np.zeros((len(sets), 512), dtype=bool)
    for row, numbers in zip(bits, sets):
        row[(numbers * _PRIME) >> np.uint64(55)] = True
    return np.packbits(bits, axis=1).view(np.uint64)


def similar_forest(
    sets: list[frozenset] | list[np.ndarray], first: int, threshold: float
) -> list[tuple[int, int]]:
    """Links (index, index) that connect all sets whose similarity reaches the threshold.

    Compares every set from ``first`` on with the ones before it, except where both are
    connected already or their sizes rule the threshold out. In larger groups so does a bound:
    every bit of one set's mask that another's lacks is a member that the other lacks.
    """
    label = np.arange(len(sets))
    sizes = np.array([len(s) for s in sets])
    masks = _masks(sets) if len(sets) > 8 and isinstance(sets[0], np.ndarray) else None
    links = []
    for i in range(max(first, 1), len(sets)):
        fit = np.minimum(sizes[:i], sizes[i]) >= threshold * np.maximum(sizes[:i], sizes[i])
        open_ = np.flatnonzero(fit)
        if masks is not None:
            lacking = np.bitwise_count(masks[i] & ~masks[open_]).sum(axis=1, dtype=np.int64)
            common = np.minimum(sizes[i] - lacking, sizes[open_])
            open_ = open_[common >= threshold * (sizes[i] + sizes[open_] - common) - 1e-6]
        while len(open_):
            linked = next((k for k, j in enumerate(open_) if jaccard(sets[i], sets[j]) >= threshold), None)
            if linked is None:
                break
            j = int(open_[linked])
            links.append((i, j))
            old, new = max(label[i], label[j]), min(label[i], label[j])
            label[label == old] = new
            open_ = open_[linked + 1 :]
            open_ = open_[label[open_] != label[i]]
    return links


def _lines(text: bytes) -> Iterator[tuple[int, bytes]]:
    """Number and normal form of the lines that are not blank.

    A line of marks alone has no normal form; it stands for itself, behind a zero byte."""
    folded = text.translate(_FOLD_LINES)
    while b"  " in folded:
        folded = folded.replace(b"  ", b" ")
    given = None
    for number, line in enumerate(folded.split(b"\n")):
        form = line.strip(b" ")
        if not form:
            given = given or text.split(b"\n")
            marks = given[number].strip()
            if not marks:
                continue
            form = b"\0" + marks
        yield number, form


def _compared(texts: list[bytes]) -> list[bytes]:
    """Different forms that are long enough to be compared by their shingles. Shorter ones,
    and lines of marks, are alike only where they are equal."""
    return list({form for text in texts for _, form in _lines(text) if long_enough(form)})


def row_key() -> Column:
    """Number of a row: rows equal in id and text are one document that came twice."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))


def signed_lines(docs: DataFrame) -> DataFrame:
    """``row_key``, ``doc_id``, ``line_no``, ``node`` of every line that is not blank; bands and
    sketch of its node too where it is the first of a batch with a compared node, else null. Bands are packed, the highest
    ``BAND`` bytes of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            keys, ids = batch.column("row_key").to_pylist(), batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            numbers: dict[bytes, int] = {}
            forms: list[bytes] = []
            signed: list[int] = []  # where a row carries the signature of the form
            for i, text in enumerate(texts_of(batch)):
                for number, form in _lines(text):
                    node = numbers.get(form)
                    if node is None:
                        node = numbers[form] = node_of(form)
                        if long_enough(form):
                            signed.append(len(rows))
                            forms.append(form)
                    rows.append((keys[i], ids[i], number, node))
            places = np.array(signed, dtype=np.int64)
            for low in range(0, len(rows), SLICE // BANDS):
                part = rows[low : low + SLICE // BANDS]
                first, last = np.searchsorted(places, [low, low + len(part)])
                found = signatures(forms[first:last])
                values = np.zeros((len(SKETCH), len(part)), dtype=np.int64)
                values[:, places[first:last] - low] = sketches(found).T
                packed = np.full(len(part), None, dtype=object)
                packed[places[first:last] - low] = packed_bands(found)
                empty = np.ones(len(part), dtype=bool)
                empty[places[first:last] - low] = False
                own = dict(zip(("row_key", "doc_id", "line_no", "node"), zip(*part)))
                yield own | {"bands": packed} | {c: pa.array(v, mask=empty) for c, v in zip(SKETCH, values)}

    rows = docs.select("doc_id", "text", row_key().alias("row_key"))
    schema = ["row_key long", "doc_id long", "line_no int", "node long", "bands binary", *[f"{c} long" for c in SKETCH]]
    return map_arrow(rows, ", ".join(schema), run)


def signed_nodes(lines: DataFrame) -> DataFrame:
    """``node``, its bands and its sketch: the rows of :func:`signed_lines` that carry them."""
    return lines.where("bands IS NOT NULL").drop("row_key", "doc_id", "line_no")


def banded(signed: DataFrame) -> DataFrame:
    """``bucket``, ``entries``: the bands of the rows of :func:`signed_nodes`, those of one bucket
    packed together, each with its node and the node's mark."""
    most = SLICE // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= most:
                yield _packed(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield _packed(pa.Table.from_batches(held))

    return map_arrow(signed.select("node", "bands", *SKETCH), "bucket int, entries binary", run)


def _packed(rows: pa.Table) -> dict:
    found = np.frombuffer(b"".join(rows["bands"].to_pylist()), np.uint8).reshape(-1, BAND)
    keys = np.zeros((len(found), 8), dtype=np.uint8)
    keys[:, 8 - BAND :] = found
    keys = keys.view(np.uint64).ravel()
    buckets = (keys >> np.uint64(52)).astype(np.uint16)
    order = np.argsort(buckets, kind="stable")
    entries = np.empty(len(keys), _ENTRY)
    entries["band"] = keys[order] >> np.uint64(20) & np.uint64(0xFFFFFFFF)
    entries["node"] = rows["node"].to_numpy()[order // BANDS]
    entries["mark"] = marks(np.stack([rows[c].to_numpy() for c in SKETCH], axis=1))[order // BANDS]
    counts = np.bincount(buckets, minlength=BUCKETS)
    there = np.flatnonzero(counts)
    ends = np.append(0, np.cumsum(counts[there]) * _ENTRY.itemsize).astype(np.int32)
    packed = pa.Array.from_buffers(pa.binary(), len(there), [None, pa.py_buffer(ends), pa.py_buffer(entries)])
    return {"bucket": there, "entries": packed}


def candidate_sets(found: DataFrame) -> DataFrame:
    """``cell``, ``node``: nodes that share a band and hold together by their marks, once for each set of nodes.

    ``found`` is that of :func:`banded`. A bucket that a batch ends in is held for the next batch. Where
    much is held, bands of more than ``SLICE`` nodes are passed on as they come, numbered by the band;
    bands of more than ``BLOCK`` nodes are passed on whole.
    """
    block, most = BLOCK, SLICE

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, entries = np.zeros(0, dtype=np.int64), np.zeros(0, _ENTRY)
        passing, limit = np.zeros(0, dtype=np.int64), 16 * most
        for frame in frames:
            more = np.frombuffer(b"".join(frame["entries"]), _ENTRY)
            buckets = np.repeat(frame["bucket"].to_numpy(np.int64), frame["entries"].map(len) // _ENTRY.itemsize)
            keys = np.concatenate([keys, buckets << 32 | more["band"]])
            entries = np.concatenate([entries, more])
            if not len(keys):
                continue
            cut = int(np.searchsorted(keys >> 32, keys[-1] >> 32))  # start of the open bucket
            yield from _marked_sets(keys[:cut], entries[:cut], passing, block)
            keys, entries = keys[cut:], entries[cut:]
            if cut:
                limit = 16 * most
            if len(keys) > limit:
                order = np.lexsort((entries["node"], keys))
                keys, entries = keys[order], entries[order]
                fresh = np.append(True, (keys[1:] != keys[:-1]) | (entries["node"][1:] != entries["node"][:-1]))
                keys, entries = keys[fresh], entries[fresh]
                bands_, counts = np.unique(keys, return_counts=True)
                passing = np.union1d(passing, bands_[counts > most])
                gone = np.isin(keys, passing)
                yield _sets(keys[gone], entries["node"][gone], passing)
                keys, entries = keys[~gone], entries[~gone]
                limit = max(16 * most, 2 * len(keys))
        yield from _marked_sets(keys, entries, passing, block)

    dealt = found.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(run, "cell long, node long").distinct()


def _marked_sets(keys: np.ndarray, entries: np.ndarray, passing: np.ndarray, block: int) -> Iterator[pd.DataFrame]:
    """Sets of the bands ``keys``, which are complete but for those that are ``passing``."""
    if len(passing):
        gone = np.isin(keys, passing)
        yield _sets(keys[gone], entries["node"][gone], passing)
        keys, entries = keys[~gone], entries[~gone]
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    shared = order[np.append(False, same) | np.append(same, False)] if len(order) else order
    keys, entries = keys[shared], entries[shared]
    order = np.lexsort((entries["node"], keys))
    keys, entries = keys[order], entries[order]
    nodes = entries["node"].copy()
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes = keys[fresh], nodes[fresh]
    own = np.zeros((len(keys), 16), dtype=np.uint8)
    own[:, :MARK] = entries["mark"][fresh]
    own = own.view(np.uint64)
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=int)
    counts = np.diff(np.append(starts, len(keys)))
    sizes = np.repeat(counts, counts)
    after = np.repeat(starts + counts, counts) - np.arange(len(keys)) - 1
    yield _sets(keys[sizes > block], nodes[sizes > block], None)
    for low, high in ((2, min(FEW, block)), (FEW + 1, block)):  # long bands take many steps, so by themselves
        use = np.flatnonzero((sizes >= low) & (sizes <= high))
        near = own[use]
        label = _together(after[use], lambda a, b: agreeing_marks(near[a], near[b]) >= AGREE)
        yield _sets(label, nodes[use], None)


def _together(after: np.ndarray, near: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The least row of the part that each row is in; ``after`` rows of its group follow a row.

    Each row meets the one ``step`` rows after it, for every step, unless both are connected."""
    label = np.arange(len(after))
    step, open_ = 1, np.flatnonzero(after > 0)
    while len(open_):
        a, b = open_, open_ + step
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
        use = near(a, b)
        _unite(label, a[use], b[use])
        step += 1
        open_ = open_[after[open_] >= step]
    return label


def _sets(keys: np.ndarray, nodes: np.ndarray, passing: np.ndarray | None) -> pd.DataFrame:
    """Rows of the runs with two nodes or more; the number of a run is that of its set.

    Runs of the bands ``passing`` come in pieces and are numbered by the band."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes = keys[fresh], nodes[fresh]
    if not len(keys):
        return pd.DataFrame({"cell": keys, "node": nodes})
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.diff(np.append(starts, len(keys)))
    values = nodes.view(np.uint64)
    number = np.add.reduceat(_mixed(values ^ values >> np.uint64(31), values), starts)
    number = _mixed(number, counts.astype(np.uint64)).view(np.int64)
    pieces = np.isin(keys[starts], passing) if passing is not None else np.zeros(len(starts), bool)
    number[pieces] = keys[starts][pieces]
    use = np.repeat((counts > 1) | pieces, counts)
    return pd.DataFrame({"cell": np.repeat(number, counts)[use], "node": nodes[use]})


def blocks_of(cells: DataFrame) -> DataFrame:
    """``cell``, ``low``, ``high``, ``side`` and the other columns: each pair of blocks of a cell.

    A cell of up to ``BLOCK`` nodes is the pair (0, 0)."""
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    large = sizes.where("parts > 1")
    rows = cells.join(broadcast_within(large), "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return other.select(
        "cell",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        *[c for c in cells.columns if c != "cell"],
    )


def alike_sets(cells: DataFrame, signed: DataFrame) -> DataFrame:
    """``cell``, ``node``: parts of the cells that hold together by their sketches, each once.

    A part has at most two blocks of nodes.
    """
    columns = ["key", "side", "node", *SKETCH]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros((0, len(columns)), dtype=np.int64)
        for frame in frames:
            held = np.concatenate([held, frame[columns].to_numpy(np.int64)])
            if not len(held):
                continue
            cut = int(np.searchsorted(held[:, 0], held[-1, 0]))  # start of the open one
            yield _alike(held[:cut])
            held = held[cut:]
        yield _alike(held)

    own = signed.groupBy("node").agg(*[F.min(c).alias(c) for c in SKETCH])
    side = F.when(F.col("low") == F.col("high"), WITHIN).otherwise(F.col("side")).cast("long")
    pairs = blocks_of(cells).select(F.xxhash64("cell", "low", "high").alias("key"), side.alias("side"), "node")
    dealt = pairs.join(own, "node").repartition("key").sortWithinPartitions("key")
    return dealt.mapInPandas(run, "cell long, node long").distinct()


def _alike(rows: np.ndarray) -> pd.DataFrame:
    """Parts of two nodes or more of the pairs of blocks, whose rows stand together."""
    if not len(rows):
        return _sets(rows[:, 0], rows[:, 2], None)
    fresh = np.append(True, rows[1:, 0] != rows[:-1, 0])
    ends = np.append(np.flatnonzero(fresh)[1:], len(rows))
    after = ends[np.cumsum(fresh) - 1] - np.arange(len(rows)) - 1
    side, sketch = rows[:, 1], np.ascontiguousarray(rows[:, 3:])

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        # Pairs inside one block are compared where the block meets itself.
        use = (side[a] == WITHIN) | (side[a] != side[b])
        use[use] = agreeing(sketch[a[use]], sketch[b[use]]) >= AGREE
        return use

    return _sets(_together(after, near), rows[:, 2], None)


def without_subsets(sets: DataFrame) -> DataFrame:
    """``sets`` less those that lie wholly in another, so that fewer texts travel.

    Found are those whose nodes all have one set as the largest they are in; others stay."""
    sizes = sets.groupBy("cell").agg(F.count("*").alias("n"))
    rows = sets.join(sizes, "cell")
    largest = rows.groupBy("node").agg(F.max(F.struct("n", "cell"))["cell"].alias("largest"))
    whole = rows.join(largest, "node").groupBy("cell").agg(F.min("largest").alias("a"), F.max("largest").alias("b"))
    inside = whole.where("a = b and a <> cell").select("cell")
    return sets.join(inside, "cell", "left_anti")


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Gives connected rows the least label among them; every label is that of itself."""
    while len(a):
        np.minimum.at(label, np.maximum(label[a], label[b]), np.minimum(label[a], label[b]))
        while not np.array_equal(further := label[label], label):
            label[:] = further
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]


def forms_of(docs: DataFrame) -> DataFrame:
    """``node``, ``form`` of every compared node, once for each batch that has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            forms = _compared(texts_of(batch))
            for low in range(0, len(forms), SLICE):
                part = forms[low : low + SLICE]
                yield {"node": [node_of(x) for x in part], "form": [x.decode() for x in part]}

    return map_arrow(docs.select("text"), "node long, form string", run)


def shingle_table(forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`shingles` of all the forms, each below the number of its form, ascending; and
    where those of each form begin. Different shingles are different numbers."""
    lines = [form.ljust(SHINGLE, "\0") for form in forms]
    owner = np.repeat(np.arange(len(lines), dtype=np.uint64), [len(line) for line in lines])
    points = np.frombuffer("".join(lines).encode("utf-32-le"), "<u4").astype(np.uint64)
    if not len(points):
        return points, np.zeros(1, dtype=np.int64)
    windows = points[: len(points) - SHINGLE + 1]
    for k in range(1, SHINGLE):
        following = points[k : len(points) - SHINGLE + 1 + k]
        if points.max() < 256:
            windows = windows << np.uint64(8) | following
        else:  # windows so far numbered by their order, so that 32 bits hold them
            windows = np.unique(windows << np.uint64(32) | following, return_inverse=True)[1].astype(np.uint64)
    whole = owner[: len(windows)] == owner[SHINGLE - 1 :]
    found = np.sort((owner[: len(windows)] << np.uint64(WINDOW_BITS) | windows)[whole])
    found = found[np.append(True, found[1:] != found[:-1])]
    heads = np.arange(len(lines) + 1, dtype=np.uint64) << np.uint64(WINDOW_BITS)
    return found, np.searchsorted(found, heads)


def similarities(found: np.ndarray, starts: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarities of the forms ``a`` with the forms ``b`` of a shingle table."""
    sizes = np.diff(starts)

    def taken(which: np.ndarray) -> np.ndarray:
        n = sizes[which]
        pair = np.repeat(np.arange(len(which), dtype=np.uint64), n)
        place = np.arange(n.sum()) + np.repeat(starts[which] - (np.cumsum(n) - n), n)
        return pair << np.uint64(WINDOW_BITS) | found[place] & np.uint64((1 << WINDOW_BITS) - 1)

    both = np.sort(np.concatenate([taken(a), taken(b)]), kind="stable")  # merges two ascending runs
    same = both[1:][both[1:] == both[:-1]] >> np.uint64(WINDOW_BITS)
    common = np.bincount(same.astype(np.int64), minlength=len(a))
    return common / (sizes[a] + sizes[b] - common)


def small_forests(cells: np.ndarray, forms: list[str], threshold: float) -> list[tuple[int, int]]:
    """Links (index, index) that connect the similar forms of each cell; cells stand together.

    Each form meets the one ``step`` rows after it, for every step, unless both are connected
    or their sizes rule the threshold out."""
    found, starts = shingle_table(forms)
    sizes = np.diff(starts)
    label = np.arange(len(forms))
    ends = np.searchsorted(cells, cells, side="right")
    after = ends - label - 1
    links: list[tuple[int, int]] = []
    step, open_ = 1, np.flatnonzero(after > 0)
    while len(open_):
        a, b = open_, open_ + step
        fit = np.minimum(sizes[a], sizes[b]) >= threshold * np.maximum(sizes[a], sizes[b])
        use = fit & (label[a] != label[b])
        a, b = a[use], b[use]
        near = similarities(found, starts, a, b) >= threshold
        links += zip(b[near].tolist(), a[near].tolist())
        _unite(label, a[near], b[near])
        step += 1
        open_ = open_[after[open_] >= step]
    return links


def verified_links(cells: DataFrame, forms: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``src``, ``dst`` that connect the nodes of each cell with similarity enough.

    Cells of up to ``FEW`` nodes are compared many at a time, larger ones alone."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame({"cell": np.zeros(0, np.int64), "node": np.zeros(0, np.int64), "form": np.zeros(0, object)})
        for frame in frames:
            held = pd.concat([held, frame[["cell", "node", "form"]]], ignore_index=True)
            if not len(held):
                continue
            keys = held["cell"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # start of the open one
            yield _links(held.iloc[:cut], threshold)
            held = held.iloc[cut:]
        yield _links(held, threshold)

    texts = cells.join(forms.dropDuplicates(["node"]), "node")
    dealt = texts.repartition("cell").sortWithinPartitions("cell", "node")
    return dealt.mapInPandas(run, "src long, dst long")


def _links(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between nodes of whole cells, in order of the cells."""
    cells, nodes, forms = rows["cell"].to_numpy(), rows["node"].to_numpy(), rows["form"].tolist()
    starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])) if len(cells) else np.zeros(0, int)
    links: list[tuple[int, int]] = []
    some: list[int] = []  # rows of small cells that wait for others
    chars = 0
    for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(cells)]):
        if high - low > FEW:
            sets = shingle_sets(forms[low:high])
            links += [(low + i, low + j) for i, j in similar_forest(sets, 1, threshold)]
        elif high - low > 1:
            some += range(low, high)
            chars += sum(map(len, forms[low:high]))
        if some and (chars > CHARS or high == len(cells)):
            found = small_forests(cells[some], [forms[i] for i in some], threshold)
            links += [(some[i], some[j]) for i, j in found]
            some, chars = [], 0
    ends = np.array(links, dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame({"src": nodes[ends[:, 0]], "dst": nodes[ends[:, 1]]})


def removed_lines(docs: DataFrame, scratch: Scratch, threshold: float = THRESHOLD) -> DataFrame:
    """``row_key``, ``removed``: numbers of the lines that go from each row, ascending.

    Of a component the line of the smallest (doc_id, row, line number) stays.
    """
    with transient_shuffles(docs.sparkSession):
        read = scratch.table(signed_lines(docs), "signed")
        signed = signed_nodes(read)
        cells = scratch.table(candidate_sets(banded(signed)), "cells")
        alike = scratch.table(alike_sets(cells, signed), "alike")
        alike = scratch.table(without_subsets(alike), "largest")
        nodes = scratch.table(alike.select("node").distinct(), "nodes")
        forms = forms_of(docs).join(broadcast_within(nodes), "node", "left_semi")
        links = scratch.table(verified_links(alike, forms, threshold), "links")
    members = connected_components(links, scratch)
    lines = read.join(broadcast_within(members), "node", "left").select(
        "row_key", "doc_id", "line_no", F.coalesce("component", "node").alias("component")
    )
    lines = scratch.table(lines, "lines")
    place = F.struct("doc_id", "row_key", "line_no")
    first = lines.groupBy("component").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = scratch.table(first.select("component", "first"), "first")
    gone = lines.join(first, "component").where(
        ~(F.col("first.row_key").eqNullSafe(F.col("row_key")) & (F.col("first.line_no") == F.col("line_no")))
    )
    return gone.groupBy("row_key").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` with ``text`` cleaned, and ``n_lines``, ``n_removed``, ``removed``.

    Lines of fewer than ``LEAST_CHARS`` characters in normal form, and lines of marks alone,
    go only where an equal one came before. Blank lines always stay. A null text stays null. Rows equal in id and text are one document twice:
    both keep the same lines. The other columns are carried along (one named like an added
    column is replaced). An empty table gives an empty one. The text itself is shuffled
    once at the end, or not at all where the removed lines measure little.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    gone = scratch.table(removed_lines(rows, scratch, threshold), "removed")
    gone = gone.select(F.col("row_key").alias("l_key"), F.col("removed").alias("l_removed"))
    kept = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed", "removed")]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("l_row")
    near = broadcast_within(gone) if _small(gone) else gone
    joined = docs.select(row, row_key().alias("l_own")).join(near, F.col("l_own") == F.col("l_key"), "left")
    split = joined.select(
        "l_row",
        F.split(F.col("l_row.text"), "\n").alias("l_lines"),
        F.coalesce("l_removed", F.array().cast("array<int>")).alias("l_removed"),
    )
    places = F.array_except(F.sequence(F.lit(0), F.size("l_lines") - 1), "l_removed")
    rest = F.array_join(F.transform(places, lambda i: F.get("l_lines", i)), "\n")
    return split.select(
        *[F.col("l_row")[c].alias(c) for c in kept],
        F.when(F.col("l_row.text").isNotNull(), rest).alias("text"),
        F.coalesce(F.when(F.col("l_row.text").isNotNull(), F.size("l_lines")), F.lit(0)).alias("n_lines"),
        F.size("l_removed").alias("n_removed"),
        F.array_join(F.col("l_removed").cast("array<string>"), ",").alias("removed"),
    )


def _small(gone: DataFrame, limit: int = 32 << 20) -> bool:
    """Whether the lists of removed lines are small enough to go to every executor."""
    size = gone.agg(F.sum(F.size("l_removed") * 4 + 48)).first()[0]
    return (size or 0) <= limit


def without_duplicate_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with cleaned texts, in the columns of ``docs``; ``n_chars`` follows the text."""
    cleaned = dedup_lines(docs, threshold).select(*[f"`{c}`" for c in docs.columns])
    return with_length(cleaned)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))
