"""Near-duplicates by SimHash: all pairs of fingerprints within a small Hamming distance.

Equal fingerprints are one class. The classes are dealt out by the top of a vantage-point tree
grown on a bounded sample: a node sends a fingerprint to the near or the far side of its
vantage point by Hamming distance, and to both if it lies on the boundary. Of two fingerprints
at distance 2 or less some point between them is within 1 of each, so sending everything within
1 of the boundary to both sides brings every such pair together in a shard; by the triangle
inequality all other branches are pruned. Each shard goes on splitting the same way, down to
blocks that are compared in full, and returns a spanning forest of its links. A shard too dense
to split is dealt out again by those middle points themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.llm.columnar import buffers, pieces, row_keys, typed
from tripkit.llm.components import connected_components
from tripkit.session import materialize

#: Links join fingerprints that differ in at most this many bits; the overlap of shards follows from it.
MAX_BITS = 2
#: Fingerprints of the sample that the shared tree is grown on; fingerprints a shard should hold.
SAMPLE, SHARD = 8192, 4000
#: Blocks of at most this many fingerprints are compared in full; sides that keep more than this share do not split.
BLOCK, DENSE = 1024, 0.85
#: Parts a dense shard is dealt out to.
DENSE_PARTS = 64


def text_fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    """The 64-bit SimHash of each text: words, A-Z lower-cased, in shingles joined by a space."""
    hashes: list[int] = []
    limits = [0]
    for text in texts:
        parts = text.lower().split()
        if len(parts) <= shingle:
            hashes.extend([xxhash.xxh64_intdigest(b" ".join(parts), 42)] if parts else [])
        else:
            line = b" ".join(parts)
            ends = np.cumsum([len(p) + 1 for p in parts]) - 1
            starts = [0, *(ends[: len(parts) - shingle] + 1).tolist()]
            hashes.extend([xxhash.xxh64_intdigest(line[s:e], 42) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)])
        limits.append(len(hashes))
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros(len(texts), np.uint64)
    n = np.diff(limits)
    full = np.flatnonzero(n)
    if len(full):
        counts = np.add.reduceat(bits, np.array(limits)[full], axis=0, dtype=np.int32)
        out[full] = np.packbits(counts * 2 > n[full, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, limits = buffers(batch.column(1))
        found = [text_fingerprints([data[limits[k] : limits[k + 1]].tobytes() for k in range(first, last)], shingle)
                 for first, last in pieces(limits, 1 << 19)]
        values = np.concatenate(found) if found else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["_id", "fp"])


def fingerprints(docs: DataFrame, id_column: str, text_column: str, shingle: int = 3) -> DataFrame:
    """_id and fp, the fingerprint's 64 bits as a bigint."""
    texts = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("_text"))
    return texts.mapInArrow(partial(fingerprint_batches, shingle=shingle), typed(docs, id_column, "fp bigint"))


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def boundary(points: np.ndarray, tries: int = 6) -> tuple[np.uint64, int, float] | None:
    """A vantage point and radius with few points on the boundary; None if no side gets smaller enough."""
    best = None
    for vantage in points[:: max(1, len(points) // tries)][:tries]:
        inside = np.cumsum(np.bincount(distances(points, vantage), minlength=66)) / len(points)
        # near side: distance <= radius + 1; far side: distance >= radius
        for radius in range(1, 64):
            share = max(inside[radius + 1], 1 - inside[radius - 1])
            if best is None or share < best[2]:
                best = vantage, radius, share
    return best if best and best[2] <= DENSE else None


@dataclass
class Node:
    """A branch (vantage, radius, near, far) or a shard, dense if it could not be split."""

    vantage: np.uint64 | None = None
    radius: int = 0
    near: Node | None = None
    far: Node | None = None
    shard: int = 0
    dense: bool = False


def grow(sample: np.ndarray, smallest: int, shards: list[Node]) -> Node:
    found = boundary(sample) if len(sample) > smallest else None
    if found is None:
        node = Node(shard=len(shards), dense=len(sample) > 4 * smallest)
        shards.append(node)
        return node
    vantage, radius, _ = found
    d = distances(sample, vantage)
    return Node(vantage, radius, grow(sample[d <= radius + 1], smallest, shards), grow(sample[d >= radius], smallest, shards))


def dealt(points: np.ndarray, node: Node) -> Iterator[tuple[Node, np.ndarray]]:
    """The shards that points within 1 of the given ones may lie in."""
    if not len(points):
        return
    if node.vantage is None:
        yield node, points
        return
    d = distances(points, node.vantage)
    yield from dealt(points[d <= node.radius + 1], node.near)
    yield from dealt(points[d >= node.radius], node.far)


def middles(points: np.ndarray) -> np.ndarray:
    """Each point and its 64 neighbours, a row per point."""
    return points[:, None] ^ np.r_[np.uint64(0), np.uint64(1) << np.arange(64, dtype=np.uint64)][None, :]


def dealt_batches(batches: Iterator[pa.RecordBatch], tree: Node, n_shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for node, own in dealt(points, tree):
            if node.dense:
                for first in range(0, len(own), 4096):
                    part = own[first : first + 4096]
                    middle = middles(part).ravel()
                    place = n_shards + node.shard * DENSE_PARTS + (middle * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(58)).astype(np.int64)
                    yield shard_rows(place, np.repeat(part, 65), middle)
            else:
                yield shard_rows(np.full(len(own), node.shard), own, None)


def shard_rows(shard: np.ndarray, points: np.ndarray, middle: np.ndarray | None) -> pa.RecordBatch:
    middles_ = pa.nulls(len(points), pa.int64()) if middle is None else pa.array(middle.view(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int64)), pa.array(points.view(np.int64)), middles_],
                                      names=["shard", "fp", "middle"])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of the component of each of n nodes under the edges (a, b)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        for end in (a, b):
            np.minimum.at(label, label[end], least)
            np.minimum.at(label, end, least)
        label = label[label]
        if np.array_equal(label, before):
            return label


def links(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as pairs, of all links among distinct points."""
    if len(points) <= BLOCK:
        a, b = np.nonzero(np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= MAX_BITS, 1))
        return spanning(points, a, b)
    found = boundary(points)
    if found is None:
        return by_middle(np.repeat(points, 65), middles(points).ravel())
    d = distances(points, found[0])
    near, far = links(points[d <= found[1] + 1]), links(points[d >= found[1]])
    return np.r_[near[0], far[0]], np.r_[near[1], far[1]]


def spanning(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    label = forest(len(points), a, b)
    moved = np.flatnonzero(label != np.arange(len(points)))
    return points[moved], points[label[moved]]


def by_middle(points: np.ndarray, middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of points that share a middle point."""
    order = np.argsort(middle, kind="stable")
    same = middle[order][1:] == middle[order][:-1]
    names, place = np.unique(points, return_inverse=True)
    return spanning(names, place[order][:-1][same], place[order][1:][same])


def linked(group: pa.Table) -> pa.Table:
    points = group.column("fp").to_numpy().view(np.uint64)
    if group.column("middle").null_count:
        a, b = links(np.unique(points))
    else:
        a, b = by_middle(points, group.column("middle").to_numpy().view(np.uint64))
    return pa.table({"u": a.view(np.int64), "v": b.view(np.int64)})


def fingerprint_links(classes: DataFrame, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """Edges (u, v) that connect what links at MAX_BITS or fewer connect, among distinct ``fp``."""
    n = classes.count()
    share = min(1.0, sample / max(1, n))
    drawn = classes.where(F.pmod(F.xxhash64("fp"), F.lit(1_000_000)) < round(share * 1_000_000))
    points = np.sort(np.array([r.fp for r in drawn.select("fp").collect()], np.int64).view(np.uint64))
    shards: list[Node] = []
    tree = grow(np.random.default_rng(0).permutation(points), max(8, int(shard * share)), shards)
    rows = classes.select("fp").mapInArrow(partial(dealt_batches, tree=tree, n_shards=len(shards)), "shard bigint, fp bigint, middle bigint")
    return rows.groupBy("shard").applyInArrow(linked, "u bigint, v bigint")


def classes_of(found: DataFrame) -> DataFrame:
    """(fp, class): the class of each fingerprint, named by its least member."""
    distinct = materialize(found.select("fp").distinct())
    parts = connected_components(fingerprint_links(distinct))
    return distinct.join(parts, distinct["fp"] == parts["node"], "left").select("fp", F.coalesce("component", "fp").alias("class"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, fp, component_id (the smallest id reachable by links).

    A null or empty text, or one without words, has fingerprint zero and is linked like any other.
    Null ids are never the smallest unless a component has no other. Equal rows are one class;
    other columns are not read.
    """
    found = materialize(fingerprints(docs, id_column, text_column, shingle))
    named = materialize(found.groupBy("fp").agg(F.min("_id").alias("least")).join(classes_of(found), "fp"))
    least = named.groupBy("class").agg(F.min("least").alias("component_id"))
    of = named.join(least, "class").select("fp", "component_id")
    return found.join(of, "fp").select(F.col("_id").alias(id_column), "fp", "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the one of the smallest id, null ids last.

    Rows of that id are told apart by hashes of their text; of rows equal in id and text one stays.
    Texts without words are one class, as in ``near_duplicates``.
    All columns stay, whatever their names.
    """
    keys = row_keys(id_column, text_column)
    row = F.struct(F.col(id_column).isNull().alias("no_id"), F.col(id_column).alias("id"), *keys)
    found = materialize(fingerprints(docs.select(row.alias("_row"), F.col(text_column).alias("_text")), "_row", "_text", shingle))
    first = found.join(classes_of(found), "fp").groupBy("class").agg(F.min("_id").alias("row")).select("row._key_a", "row._key_b")
    marked = docs.select(F.struct("*").alias("_doc"), *keys)
    return (marked.join(first, ["_key_a", "_key_b"], "left_semi").groupBy("_key_a", "_key_b")
            .agg(F.first("_doc").alias("_doc")).select("_doc.*"))
