"""Cross-tokenizer alignment: which ids of two tokenizers stand for the same stretch of text.

Both tokenizers cut the same bytes. A dictionary from the byte at which a token ends to the token's
index is made for each; the keys that both hold, sorted, are the places where the two agree, and slice
both id lists into groups. Within a group every id of one is linked with every id of the other. How
many documents hold a pair of ids linked is counted over the whole table, and each document's links
are then weighed by those counts.

Both tokenizers always end a token before a space or a line feed that follows another character, so
texts are aligned stretch by stretch between such places, each distinct stretch of a chunk once.

A task gathers the distinct pairs of a chunk of documents, so the shuffles carry one row per pair and
chunk; the pairs of each document stay packed as places in their chunk's list. A pair that every
document holds has one row per chunk. One A id stands beside at most as many B ids as that vocabulary
has, which bounds the group in which its best pair is found.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripkit.llm.columnar import buffers, pieces
from tripkit.llm.pieces import SPACE, PieceEncoder, stretch_starts
from tripkit.llm.tokens import BYTE_WORDS, PLAIN, Encoder
from tripkit.session import materialize

#: Bytes of text whose pairs a task gathers before it closes a chunk.
CHUNK_BYTES = 8 << 20
#: Stretches that are aligned, or gathered for their documents, at a time.
STEP_STRETCHES = 50_000
#: Bytes whose ends are held in dictionaries at a time: equal ends fall into the same step.
STEP_BYTES = 1 << 20
#: Links of a group from which its ids are counted before they are paired.
LARGE = 256


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray, step: int = STEP_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Number of A and of B tokens up to each place where tokens of both end, in order."""
    a_cuts, b_cuts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    size = int(a_ends[-1]) if len(a_ends) else 0
    for first in range(0, size, step):
        limits = [np.searchsorted(ends, (first, first + step), "right").tolist() for ends in (a_ends, b_ends)]
        a_at, b_at = (dict(zip(ends[low:high].tolist(), range(low + 1, high + 1), strict=True))
                      for ends, (low, high) in zip((a_ends, b_ends), limits, strict=True))
        common = sorted(a_at.keys() & b_at.keys())
        a_cuts.append(np.fromiter(map(a_at.__getitem__, common), np.int64, len(common)))
        b_cuts.append(np.fromiter(map(b_at.__getitem__, common), np.int64, len(common)))
    return np.concatenate(a_cuts), np.concatenate(b_cuts)


def linked(a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs, A id in the high half, the links of each, and where each group's pairs begin.

    A large group's pairs are distinct and bear their number of links, others bear one link each.
    """
    a_first, b_first = np.r_[0, a_cuts[:-1]], np.r_[0, b_cuts[:-1]]
    a_size, b_size = a_cuts - a_first, b_cuts - b_first
    counts = a_size * b_size
    found = {}
    for g in np.flatnonzero(counts >= LARGE).tolist():
        own, n_own = np.unique(a[a_first[g] : a_cuts[g]], return_counts=True)
        other, n_other = np.unique(b[b_first[g] : b_cuts[g]], return_counts=True)
        found[g] = ((own[:, None] << np.uint64(32) | other[None, :]).ravel(), (n_own[:, None] * n_other[None, :]).ravel())
        counts[g] = 0
    small = counts.copy()
    for g, (pairs, _) in found.items():
        counts[g] = len(pairs)
    limits = np.r_[0, np.cumsum(counts)]
    group = np.repeat(np.arange(len(small)), small)
    place = np.arange(len(group)) - np.repeat(np.cumsum(small) - small, small)
    pairs, links = np.empty(limits[-1], np.uint64), np.ones(limits[-1], np.int64)
    pairs[limits[group] + place] = a[a_first[group] + place // b_size[group]] << np.uint64(32) | b[b_first[group] + place % b_size[group]]
    for g, (own, n) in found.items():
        pairs[limits[g] : limits[g + 1]], links[limits[g] : limits[g + 1]] = own, n
    return pairs, links, limits


def distinct(pairs: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, rising, and the links of each."""
    if not len(pairs):
        return pairs, links
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    return pairs[first], np.add.reduceat(links[order], first)


class Entries:
    """What each distinct stretch of a chunk comes to; ``whole`` where both id lists make up its bytes."""

    def __init__(self, n: int) -> None:
        self.whole, self.counts = np.zeros(n, bool), np.zeros((4, n), np.int64)  # A ids, B ids, groups, links
        self.order: list[np.ndarray] = []
        self.parts: list[list[pa.Array]] = [[], [], []]

    def add(self, own: np.ndarray, counts: list[np.ndarray], texts: tuple, pairs: tuple, links: tuple) -> None:
        self.whole[own], self.counts[:, own] = True, counts
        self.order.append(own)
        for part, (data, limits) in zip(self.parts, (texts, pairs, links), strict=True):
            part.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(own), [None, pa.py_buffer(limits.astype(np.int64)), pa.py_buffer(data)]))

    def close(self) -> None:
        """Makes groups as written, pairs and links of pairs arrays to take from, by ``place`` of a stretch."""
        order = np.concatenate([*self.order, np.zeros(0, np.int64)])
        self.place = np.full(len(self.whole), len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.written, self.pairs, self.links = (pa.concat_arrays([*p, pa.array([b""], pa.large_binary())]) for p in self.parts)


class Aligner:
    """Two tokenizers and the bytes of their ids."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = Encoder(a_path, plain=True), PieceEncoder(b_path)
        self.ranked = self.a.ranked()
        bytes_of = self.a.byte_table(), self.b.bytes
        self.sizes = tuple(np.array([len(x) for x in own]) for own in bytes_of)
        self.tables = tuple(pa.array(own, pa.large_binary()) for own in bytes_of)
        self.split = self.b.split and self.a.pattern is BYTE_WORDS
        # an id in the middle or at the end of its side of a group, for A and for B
        written = [f"{k}{mark}" for own, marks in zip(bytes_of, (",|", ",;"), strict=True) for k in range(len(own)) for mark in marks]
        self.written, self.widths = pa.array(written, pa.large_binary()), np.array([len(x) for x in written])

    def starts(self, data: np.ndarray, limits: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Where the stretches of texts begin, each text behind its space; such a text as may not be cut is one."""
        first = np.zeros(len(data), bool)
        first[stretch_starts(data)] = True
        uncut = pc.match_substring(texts, SPACE).to_numpy(zero_copy_only=False) | (not self.split)
        for k in np.flatnonzero(uncut).tolist():
            first[limits[k] : limits[k + 1]] = False
        first[limits[:-1]] = True
        return np.flatnonzero(first)

    def entries(self, stretches: pa.Array) -> Entries:
        """Entries of distinct stretches, aligned as few runs of bytes."""
        found = Entries(len(stretches))
        for at in range(0, len(stretches), STEP_STRETCHES):
            new = [x.decode() for x in stretches.slice(at, STEP_STRETCHES).to_pylist()]
            # only behind a character that is no white space the next stretch is cut off for certain
            kinds = [2 if s[-1].isspace() else 0 if self.ranked and PLAIN.fullmatch(s) else 1 for s in new]
            for kind in (0, 1):
                own = [k for k, x in enumerate(kinds) if x == kind]
                self.enter(found, at, [new[k] for k in own], np.array(own, np.int64), kind)
            for k, x in enumerate(kinds):
                if x == 2:
                    self.enter(found, at, [new[k]], np.array([k]), 1)
        found.close()
        return found

    def enter(self, found: Entries, at: int, new: list[str], own: np.ndarray, kind: int) -> None:
        if not new:
            return
        joined = "".join(new)
        data = joined.encode()
        ends = np.cumsum(np.fromiter((len(s.encode()) for s in new), np.int64, len(new)))
        a = np.array(self.ranked.encode_ordinary(joined), np.int64) if kind == 0 else np.frombuffer(self.a.encode_whole(joined), "<u4").astype(np.int64)
        ids = self.b.encode(new)
        n_b = np.fromiter(map(len, ids), np.int64, len(new))
        b = np.fromiter(chain.from_iterable(ids), np.int64, int(n_b.sum()))
        a_ends, b_ends = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        if not (all(table.take(pa.array(x)).buffers()[2] == data for table, x in zip(self.tables, (a, b), strict=True))
                and np.array_equal(b_ends[np.cumsum(n_b) - 1], ends)):
            for k in range(len(new) if len(new) > 1 else 0):  # find the ones whose bytes differ
                self.enter(found, at, new[k : k + 1], own[k : k + 1], kind)
            return
        a_cuts, b_cuts = common_ends(a_ends, b_ends)
        groups = np.r_[0, np.searchsorted(a_ends[a_cuts - 1], ends, "right")]
        n_a = np.diff(np.r_[0, a_cuts[groups[1:] - 1]])
        pairs, links, limits = linked(a.astype(np.uint64), b.astype(np.uint64), a_cuts, b_cuts)
        text, text_ends = self.write(a, b, a_cuts, b_cuts)
        limits = limits[groups]
        total = np.diff(np.r_[0, np.cumsum(links)][limits])
        found.add(at + own, [n_a, n_b, np.diff(groups), total], (text, text_ends[np.r_[0, np.cumsum(n_a + n_b)]]),
                  (pairs, limits * 8), (links, limits * 8))

    def write(self, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
        """Groups as ``a1,a2|b1;a3|b2,b3;`` and where each of its ids begins."""
        a_last, b_last = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        a_last[a_cuts - 1], b_last[b_cuts - 1] = 1, 1
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.r_[0, b_cuts[:-1]][a_group]] = 2 * a + a_last
        codes[np.arange(len(b)) + a_cuts[b_group]] = 2 * (len(self.sizes[0]) + b) + b_last
        return self.written.take(pa.array(codes)).buffers()[2], np.r_[0, np.cumsum(self.widths[codes])]

    def facts(self, texts: pa.Array) -> list[tuple[tuple, np.ndarray, np.ndarray]]:
        """Per text (null: empty): (n_a, n_b, n_groups, n_links, groups_sha256), its distinct pairs, the links of each."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        own = np.flatnonzero(pc.binary_length(texts).to_numpy())
        out = [((0, 0, 0, 0, ""), np.zeros(0, np.uint64), np.zeros(0, np.int64))] * len(texts)
        if not len(own):
            return out
        texts = texts.take(pa.array(own))
        data, limits = buffers(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string())))
        starts = self.starts(data, limits, texts)
        cuts = np.searchsorted(starts, limits)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.r_[starts, len(data)]), pa.py_buffer(data)]).dictionary_encode()
        codes = coded.indices.to_numpy()
        entries = self.entries(coded.dictionary)
        whole = np.logical_and.reduceat(entries.whole[codes], cuts[:-1])
        counts = np.stack([np.add.reduceat(n[codes], cuts[:-1]) for n in entries.counts], 1).tolist()
        at = 0
        while at < len(own):
            last = max(at + 1, int(np.searchsorted(cuts, cuts[at] + STEP_STRETCHES, "right")) - 1)
            digests, pairs, links = self.gathered(entries, codes[cuts[at] : cuts[last]], cuts[at : last + 1] - cuts[at])
            for k in range(at, last):
                if whole[k]:
                    out[own[k]] = (*counts[k], digests[k - at]), pairs[k - at], links[k - at]
            at = last
        return out

    def gathered(self, entries: Entries, codes: np.ndarray, cuts: np.ndarray) -> tuple[list, list, list]:
        """Digest, distinct pairs and their links of each run of stretches; a long run is taken step by step."""
        if len(cuts) == 2:
            digest, tail = hashlib.sha256(), b""
            pairs, links = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            for first in range(0, len(codes), STEP_STRETCHES):
                place = pa.array(entries.place[codes[first : first + STEP_STRETCHES]])
                text = entries.written.take(place).buffers()[2].to_pybytes()[: int(pc.sum(pc.binary_length(entries.written.take(place))).as_py())]
                digest.update(tail + text[:-1])  # without the mark behind the last id, until more follow
                tail = text[-1:]
                more = [np.frombuffer(x.take(place).buffers()[2], kind) for x, kind in ((entries.pairs, np.uint64), (entries.links, np.int64))]
                pairs, links = distinct(np.r_[pairs, more[0]], np.r_[links, more[1]])
            return [digest.hexdigest()], [pairs], [links]
        place = pa.array(entries.place[codes])
        (text, text_at), (pairs, at), (links, _) = (buffers(x.take(place)) for x in (entries.written, entries.pairs, entries.links))
        pairs, links, at, view = pairs.view(np.uint64), links.view(np.int64), (at[cuts] // 8).tolist(), memoryview(text)
        digests = [hashlib.sha256(view[low : high - 1]).hexdigest() for low, high in itertools.pairwise(text_at[cuts].tolist())]
        if int(links.max(initial=1)) == 1:
            found = [np.unique(pairs[low:high], return_counts=True) for low, high in itertools.pairwise(at)]
        else:
            found = [distinct(pairs[low:high], links[low:high]) for low, high in itertools.pairwise(at)]
        return digests, [p for p, _ in found], [n for _, n in found]


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of this Python worker, kept from task to task."""
    return Aligner(a_path, b_path)


FACTS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def narrow(values: np.ndarray) -> bytes:
    """Non-negative integers in the fewest bytes each that hold the largest."""
    return values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8).tobytes()


def wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def chunk_batches(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Texts to chunks: each document's facts, and its pairs as places in the chunk's list of pairs."""
    own, part = aligner(a_path, b_path), TaskContext.get().partitionId()
    waiting: list[pa.RecordBatch] = []
    size = number = 0

    def close() -> pa.RecordBatch:
        rows = pa.Table.from_batches(waiting).combine_chunks()
        facts, pairs, links = zip(*own.facts(rows.column(1).combine_chunks()), strict=True)
        found, place, docs = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
        names = pa.chunked_array(rows.column(0)).combine_chunks()
        columns = [pa.array([part << 32 | number], pa.int64()), *(pa.array([x], pa.list_(pa.int64())) for x in (found.astype(np.int64), docs)),
                   pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)]
        columns += [pa.array([list(x)], pa.list_(pa.string() if name == FACTS[-1] else pa.int64())) for name, x in zip(FACTS, zip(*facts, strict=True), strict=True)]
        packed = [narrow(np.array([len(x) for x in pairs])), narrow(place), narrow(np.concatenate(links))]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array([x], pa.binary()) for x in packed)],
                                          names=["chunk", "pairs", "docs", "ids", *FACTS, "sizes", "places", "links"])

    for batch in batches:
        limits = np.r_[0, np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))]
        for first, last in pieces(limits, chunk_bytes // 4):
            waiting.append(batch.slice(first, last - first))
            size += int(limits[last] - limits[first])
            if size >= chunk_bytes:
                yield close()
                waiting, size, number = [], 0, number + 1
    if waiting:
        yield close()


def weighed(chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of one chunk with their links weighed by the counts of its pairs."""
    n_docs = len(chunk.column("ids")[0])
    by_pair, best = np.zeros((2, len(counts)), np.int64)
    at = counts.column("place").to_numpy()
    by_pair[at], best[at] = counts.column("n").to_numpy(), counts.column("best").to_numpy(zero_copy_only=False)
    sizes = wide(chunk.column("sizes")[0].as_py(), n_docs)
    limits = np.r_[0, np.cumsum(sizes)]
    places, links = (wide(chunk.column(c)[0].as_py(), int(limits[-1])) for c in ("places", "links"))
    total = [np.diff(np.r_[0, np.cumsum(links * x[places])][limits]) for x in (best, by_pair)]
    return pa.table([*(chunk.column(c)[0].values for c in ("ids", *FACTS)), *(pa.array(x, pa.int64()) for x in total)],
                    names=["_id", *FACTS, "n_best", "count_sum"])


def align(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text",
          chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum.

    ``a_path`` is a byte-level tokenizer file that gets a space and the text, ``b_path`` a piece model,
    which puts that space itself. Strings of special tokens inside texts are plain text. A text that is
    null, empty, or not made up again by the bytes of both its id lists has no tokens, an empty digest
    and zeros. A pair's count is the number of rows that hold it linked: rows with equal ids or texts,
    and null ids, count one by one and are all returned. Ties for the highest count of an A id are all
    best. Other columns are not read; an empty table gives no row.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    lists = ", ".join(f"{c} array<{'string' if c == FACTS[-1] else 'bigint'}>" for c in FACTS)
    chunks = materialize(docs.select(F.col(id_column), F.col(text_column)).mapInArrow(
        partial(chunk_batches, a_path=a_path, b_path=b_path, chunk_bytes=chunk_bytes),
        f"chunk bigint, pairs array<bigint>, docs array<bigint>, ids array<{kind}>, {lists}, sizes binary, places binary, links binary"))
    counts = (chunks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("_")).select("_.*")
              .groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("n")))
    own = Window.partitionBy(F.shiftright("pair", 32))
    marked = counts.select("pair", "n", (F.col("n") == F.max("n").over(own)).alias("best"))
    held = chunks.select(F.col("chunk").alias("owner"), F.posexplode("pairs").alias("place", "pair"))
    found = held.join(marked, "pair").select("owner", "place", "n", "best")
    out = ", ".join(f"{c} {'string' if c == FACTS[-1] else 'bigint'}" for c in [*FACTS, "n_best", "count_sum"])

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        return weighed(left, right)

    return (chunks.drop("pairs", "docs").groupBy("chunk").cogroup(found.groupBy("owner"))
            .applyInArrow(task, f"_id {kind}, {out}").withColumnRenamed("_id", id_column))
