"""Near-duplicate documents by SimHash, searched with BK-trees.

A fingerprint has 64 bits, each the majority of that bit over the hashes of all shingles.
Two fingerprints that differ in at most r bits agree in one of r + 1 blocks of bits, so
each fingerprint goes to one shard for the value of each block, and every link lies in a
shard. The trees are dealt to the searches by that key rather than broadcast, because their
size grows with the corpus. In a shard a BK-tree holds the fingerprints, children keyed by
their distance to the parent; a search follows only edges within the radius. It reports a
spanning forest of the shard, not its pairs, and the forests of all shards are joined by
distributed label propagation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.functions.storage import Scratch
from basketry.llm.components import connected_components
from basketry.llm.tasks import blank_words, map_arrow, table, texts_of

SHINGLE = 4
SEED = 42
RADIUS = 4
_SLICE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a text: bit set if set in over half of the shingle hashes, repeats counted."""
    words = blank_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for low in range(0, len(hashes), _SLICE):
        part = hashes[low : low + _SLICE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and signed 64-bit ``simhash`` of each row; null counts as empty."""
    return _keyed_fingerprints(docs.select("doc_id", "text"), shingle)


def _keyed_fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``simhash`` beside the columns of numbers that ``docs`` has besides ``text``."""
    names = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in texts_of(batch)]
            yield {
                **{c: batch.column(c) for c in names},
                "simhash": np.array(found, dtype=np.uint64).view(np.int64),
            }

    schema = ", ".join([f"{c} long" for c in names] + ["simhash long"])
    return map_arrow(docs, schema, run)


class BKTree:
    """Tree over distinct fingerprints: the child of a node at an edge ``d`` holds
    fingerprints at distance ``d`` from the node. Built level by level with numpy."""

    def __init__(self, values: np.ndarray):
        self.values = values
        size = len(values)
        # children[child_from[i]:child_to[i]] of node i, with the edges in ``edges``.
        self.child_from = np.zeros(size, dtype=np.int64)
        self.child_to = np.zeros(size, dtype=np.int64)
        children, edges, filled = [], [], 0
        parents = np.zeros(1, dtype=np.int64)
        members = np.arange(1, size)
        owner = np.zeros(size - 1, dtype=np.int64)
        while len(members):
            parent = parents[owner]
            distance = np.bitwise_count(values[members] ^ values[parent]).astype(np.int64)
            order = np.argsort(parent * 65 + distance, kind="stable")
            members, parent, distance = members[order], parent[order], distance[order]
            first = np.ones(len(members), dtype=bool)
            first[1:] = (parent[1:] != parent[:-1]) | (distance[1:] != distance[:-1])
            heads = np.flatnonzero(first)
            children.append(members[heads])
            edges.append(distance[heads])
            above, start = np.unique(parent[heads], return_index=True)
            self.child_from[above] = filled + start
            self.child_to[above] = filled + np.append(start[1:], len(heads))
            filled += len(heads)
            parents = members[heads]
            owner = np.cumsum(first)[~first] - 1
            members = members[~first]
        self.children = np.concatenate([*children, np.zeros(0, np.int64)]).astype(np.int64)
        self.edges = np.concatenate([*edges, np.zeros(0, np.int64)]).astype(np.int64)

    def near(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of query, node) of all pairs within the radius."""
        query = np.arange(len(queries))
        node = np.zeros(len(queries), dtype=np.int64)
        found_query, found_node = [], []
        while len(query):
            distance = np.bitwise_count(queries[query] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            found_query.append(query[hit])
            found_node.append(node[hit])
            fan = self.child_to[node] - self.child_from[node]
            open_ = np.repeat(np.arange(len(node)), fan)
            before = np.cumsum(fan) - fan
            child = self.child_from[node][open_] + np.arange(len(open_)) - before[open_]
            within = np.abs(self.edges[child] - distance[open_]) <= radius
            query = query[open_[within]]
            node = self.children[child[within]]
        return np.concatenate(found_query), np.concatenate(found_node)


def forest(values: np.ndarray, radius: int, rows: int = 256) -> list[tuple[int, int]]:
    """Edges (index, index of its component's head) that connect what lies within the radius.

    Searches run in blocks of ``rows``; links found in a block are merged at once by
    repeated minimum labels, so memory is bounded by a block's hits.
    """
    label = np.arange(len(values))
    if len(values) < 2:
        return []
    tree = BKTree(values)
    for low in range(0, len(values), rows):
        query, node = tree.near(values[low : low + rows], radius)
        a, b = query + low, node
        while True:
            la, lb = label[a], label[b]
            open_ = la != lb
            if not open_.any():
                break
            a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while (label[label] != label).any():
                label = label[label]
    heads = label.tolist()
    return [(i, h) for i, h in enumerate(heads) if i != h]


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``src``, ``dst`` that connect all fingerprints of column ``simhash`` within
    ``radius`` bits, at most one fewer per shard than the shard has fingerprints."""
    blocks = radius + 1
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    shards = F.array(
        *[
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned("simhash", low)
                .bitwiseAND(F.lit((1 << (high - low)) - 1))
                .alias("value"),
            )
            for i, (low, high) in enumerate(zip(cuts, cuts[1:]))
        ]
    )
    keyed = distinct.select(F.explode(shards).alias("shard"), "simhash").select("shard.*", "simhash")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, key = [], None
        for frame in frames:
            keys = list(zip(frame["block"].to_numpy(), frame["value"].to_numpy()))
            values = frame["simhash"].to_numpy()
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            for start, end in zip(starts, [*starts[1:], len(keys)]):
                if keys[start] != key and held:
                    yield _links(np.concatenate(held), radius)
                    held = []
                key = keys[start]
                held.append(values[start:end])
        if held:
            yield _links(np.concatenate(held), radius)

    dealt = keyed.repartition("block", "value").sortWithinPartitions("block", "value", "simhash")
    return dealt.mapInPandas(run, "src long, dst long")


def _links(values: np.ndarray, radius: int) -> pd.DataFrame:
    found = np.array(forest(values.view(np.uint64), radius), dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame({"src": values[found[:, 0]], "dst": values[found[:, 1]]})


def simhash_components(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint``, ``component_id``.

    ``component_id`` is the smallest ``doc_id`` reachable over links, the row's own
    included; null if all ids there are null. Texts without words (null too) have
    fingerprint zero and link like any other. Repeated rows and ids give a row each. Only
    ``doc_id`` and ``text`` are read. Copies meet in one fingerprint before any search.
    The texts are read once; fingerprints and links are written to the shared folder.
    """
    scratch = Scratch(docs.sparkSession)
    marked = scratch.table(fingerprints(docs, shingle), "fingerprints")
    named = scratch.table(_components(marked, radius, scratch), "named")
    return marked.join(named, "simhash").select(
        "doc_id",
        F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def _components(marked: DataFrame, radius: int, scratch: Scratch) -> DataFrame:
    """``simhash``, ``component`` (a fingerprint of it), ``component_id`` (smallest id)."""
    distinct = scratch.table(
        marked.groupBy("simhash").agg(F.min("doc_id").alias("first_id")), "distinct"
    )
    links = scratch.table(fingerprint_links(distinct.select("simhash"), radius), "links")
    members = scratch.table(connected_components(links, scratch), "members")
    linked = members.join(distinct, F.col("node") == F.col("simhash"))
    heads = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    # Most fingerprints have no link; they stand for themselves.
    named = linked.select("simhash", "component").join(heads, "component")
    alone = distinct.join(members.select("node"), F.col("simhash") == F.col("node"), "left_anti")
    return named.select("simhash", "component", "component_id").unionByName(
        alone.select("simhash", F.col("simhash").alias("component"), F.col("first_id").alias("component_id"))
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Rows of ``docs``, of each component only one: that of the smallest id, and of rows
    with one id the first by text.

    A row stays if it is the first of its component; the few numbers that name the rows to
    keep are written, and the documents meet them by a number of id and text. Rows equal
    in both are one document that came twice, of which one stays.
    """
    scratch = Scratch(docs.sparkSession)
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))
    keyed = docs.select("doc_id", "text", key.alias("s_key"))
    marked = scratch.table(_keyed_fingerprints(keyed, shingle), "keyed")
    named = scratch.table(_components(marked.select("doc_id", "simhash"), radius, scratch), "heads")
    # Every component has one fingerprint that stands for it.
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "s_key")
    first = (
        marked.join(named, "simhash")
        .groupBy("component")
        .agg(F.min(place)["s_key"].alias("s_key"))
        .select("s_key")
    )
    first = scratch.table(first, "first")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("s_row")
    rows = docs.select(row, key.alias("s_own"))
    kept = rows.join(first, F.col("s_own") == F.col("s_key")).dropDuplicates(["s_own"])
    return kept.select(*[F.col("s_row")[c].alias(c) for c in docs.columns])


def op9_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
