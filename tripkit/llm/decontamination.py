"""Benchmark decontamination: documents that contain a test item, however long they are.

A document may be thousands of times longer than an item, so their Jaccard similarity says
little; containment of the item's five-word shingles in the document does. Items are taken in
partitions by size. Each has a MinHash signature: the least of its shingles under each of k
random orders, that is k shingles drawn evenly from it. Such a shingle occurs in a document with
a probability equal to the containment, whatever the document's length, so k is set per
partition to miss less than one pair in 10**9 at the threshold; an item no larger than k keeps
all its shingles. A document is compared only with partitions whose items it is long enough to
contain. Candidates are verified by exact containment of the shingles' words. Items with fewer
words than a shingle are a partition of their own: such an item is one shingle of its own length,
and documents are hashed at that length too, only where such items exist.

The documents are scanned where they lie, nothing is shuffled. Items are the query set: they are
taken in blocks of bounded size, one scan each, so what a task holds does not grow with either table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tripkit.llm.columnar import buffers, pieces, row_columns, typed
from tripkit.llm.exchange import ddl
from tripkit.llm.hashing import WORD_BASES, mix, word_values, windows_hash

#: Bytes of item text in one block.
ITEM_BYTES = 8 << 20
#: Accepted chance of missing a pair at the threshold.
MISS = 1e-9

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def normal_words(text: bytes) -> list[bytes]:
    """Words of ASCII letters, digits and all characters beyond ASCII; A-Z lower-cased."""
    return WORDS.findall(text.lower())


def shingles(parts: list[bytes], n: int) -> set[bytes]:
    """Distinct shingles of n words; the whole sequence if it is shorter; none without words."""
    if len(parts) <= n:
        return {b" ".join(parts)} if parts else set()
    return {b" ".join(parts[i : i + n]) for i in range(len(parts) - n + 1)}


def shingle_hashes(data: np.ndarray, limits: np.ndarray, n: int, shorter: frozenset[int] = frozenset()) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every shingle of texts laid end to end; and of every run of ``shorter`` numbers of words."""
    plain = np.where(WORD[data], LOWER[data], np.uint8(32))
    inside = plain != 32
    before, after = np.zeros((2, len(data) + 1), bool)
    before[1:], after[:-1] = inside, inside
    before[limits] = after[limits] = False
    starts, ends = np.flatnonzero(inside & ~before[:-1]), np.flatnonzero(inside & ~after[1:]) + 1
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.searchsorted(starts, limits)
    counts = np.diff(first)
    values = word_values(plain, starts, ends)
    text = np.repeat(np.arange(len(counts)), counts)
    hashes, owners = [], [np.zeros(0, text.dtype)]
    for size in (n, *sorted(shorter)):
        at = np.flatnonzero(np.arange(len(starts)) + size <= first[text + 1])
        if len(at):
            hashes.append(mix(windows_hash(values, at, size, WORD_BASES[0])))
            owners.append(text[at])
    for size in set(range(1, n)) - shorter:  # texts too short for a shingle are one
        short = np.flatnonzero(counts == size)
        if len(short):
            hashes.append(mix(windows_hash(values, first[short], size, WORD_BASES[0])))
            owners.append(short)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate([np.zeros(0, np.uint64), *hashes])[order], owner[order]


class Index:
    """Signatures of a block of items, by size."""

    def __init__(self, items: list[tuple], n: int, threshold: float) -> None:
        self.n, self.threshold = n, threshold
        self.ids = [i for i, _ in items]
        words = [normal_words(t) for _, t in items]
        self.sets = [shingles(w, n) for w in words]
        self.sizes = [min(len(w), n) for w in words]
        self.shorter = frozenset(self.sizes) - {0, n}
        signed: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        for k, (_, text) in enumerate(items):
            data = np.frombuffer(text, np.uint8)
            own = np.unique(shingle_hashes(data, np.array([0, len(data)]), n)[0])
            picked = self.signature(own)
            signed.append(picked)
            owners.append(np.full(len(picked), k))
        values, owner = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((signed, np.uint64), (owners, np.int64)))
        order = np.argsort(values, kind="stable")
        self.values, self.owners = values[order], owner[order]
        self.least = np.array([math.ceil(threshold * len(s) - 1e-9) for s in self.sets], np.int64)

    def signature(self, own: np.ndarray) -> np.ndarray:
        """The least shingle under each random order; as many orders as the size partition needs."""
        if not len(own):
            return own
        top = 1 << (len(own) - 1).bit_length()  # sizes (top / 2, top] are a partition
        # a draw misses with probability 1 - threshold; small items are kept whole
        k = math.ceil(math.log(MISS) / math.log(max(1e-9, 1 - self.threshold)))
        if top <= 2 * k:
            return own
        seeds = mix(np.arange(1, 3 * k + 1, dtype=np.uint64))  # orders may agree, so a few more
        return np.unique(own[np.argmin(mix(own[None, :] ^ seeds[:, None]), axis=1)])

    def candidates(self, hashes: np.ndarray, text: np.ndarray, sizes: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs that share a shingle of the signature and may reach the threshold."""
        if not len(self.values) or not len(hashes):
            return set()
        low = np.searchsorted(self.values, hashes)
        hit = np.flatnonzero(self.values[np.minimum(low, len(self.values) - 1)] == hashes)
        if not len(hit):
            return set()
        distinct, place = np.unique(hashes[hit], return_inverse=True)
        left, right = np.searchsorted(self.values, distinct), np.searchsorted(self.values, distinct, "right")
        found = np.unique(np.stack([text[hit], place], 1), axis=0)
        spans = right[found[:, 1]] - left[found[:, 1]]
        rows = np.repeat(found[:, 0], spans)
        items = self.owners[np.repeat(left[found[:, 1]] - np.r_[0, np.cumsum(spans)[:-1]], spans) + np.arange(spans.sum())]
        able = sizes[rows] >= self.least[items]
        return set(zip(rows[able].tolist(), items[able].tolist(), strict=True))


SHARED = pa.schema([("n_shingles", pa.int64()), ("n_shared", pa.int64()), ("containment", pa.float64())])


def contained(texts: pa.Array, index: Index) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, shingles of the item, shared ones) for the items contained in each text."""
    data, limits = buffers(texts)
    for first, last in pieces(limits, 1 << 20):
        part = limits[first : last + 1] - limits[first]
        block = data[limits[first] : limits[last]]
        hashes, text = shingle_hashes(block, part, index.n, index.shorter)
        held, sets = -1, {}
        for k, item in sorted(index.candidates(hashes, text, np.bincount(text, minlength=last - first))):
            if k != held:
                held, words, sets = k, normal_words(block[part[k] : part[k + 1]].tobytes()), {}
            size = index.sizes[item]
            if size not in sets:
                sets[size] = shingles(words, size)
            n, shared = len(index.sets[item]), len(index.sets[item] & sets[size])
            if shared / n >= index.threshold:
                yield first + k, item, n, shared


def contained_batches(batches: Iterator[pa.RecordBatch], index: Index, item_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, found = [], []
        for k, item, n, shared in contained(batch.column(1), index):
            rows.append(k)
            found.append((index.ids[item], n, shared, shared / n))
        columns = list(zip(*found, strict=True)) if found else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], item_type),
             *(pa.array(c, f.type) for c, f in zip(columns[1:], SHARED, strict=True))], names=["_id", "_item", *SHARED.names])


def clean_batches(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Rows whose text, the first column, contains no item; without that column."""
    for batch in batches:
        clean = np.ones(batch.num_rows, bool)
        clean[[k for k, *_ in contained(batch.column(0), index)]] = False
        yield pa.RecordBatch.from_arrays(batch.columns[1:], names=batch.schema.names[1:]).filter(pa.array(clean))


def without_items(docs: DataFrame, items: DataFrame, text_column: str = "text", item_column: str = "item_id",
                  item_text_column: str = "text", shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that contain no item (see ``contained_items``), with all their columns."""
    kept = docs
    for block in item_blocks(items, item_column, item_text_column):
        texts = kept.select(F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("_bytes"), F.struct("*").alias("_row"))
        clean = partial(clean_batches, index=Index(block, shingle, threshold))
        kept = texts.mapInArrow(clean, StructType([StructField("_row", docs.schema)])).select(*row_columns(docs))
    return kept


def item_blocks(items: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple]]:
    block: list[tuple] = []
    size = 0
    for item, text in items.select(id_column, text_column).where(F.col(text_column).isNotNull()).toLocalIterator():
        encoded = text.encode()
        if block and size + len(encoded) > ITEM_BYTES:
            yield block
            block, size = [], 0
        block.append((item, encoded))
        size += len(encoded)
    yield block


def contained_items(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    item_column: str = "item_id", item_text_column: str = "text", shingle: int = 5,
                    threshold: float = 0.8) -> DataFrame:
    """(id, item, n_shingles, n_shared, containment) for items whose share in a document reaches ``threshold``.

    Containment is the share of an item's distinct shingles that the document has. An item with
    fewer words than a shingle is one shingle of its own length, which a document has if these words
    stand in it in a row; a text without words, or null, contains nothing and is contained in nothing. Equal rows of either side are reported as often as they occur; null ids
    are passed on. Other columns are not read. With no items the result is empty.
    """
    item_type = items.select(item_column).limit(0).toArrow().schema.field(0).type
    texts = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("_text"))
    schema = StructType([*typed(docs, id_column, "").fields, *typed(items, item_column, ddl(SHARED), "_item").fields])
    found = [texts.mapInArrow(partial(contained_batches, index=Index(block, shingle, threshold), item_type=item_type), schema)
             for block in item_blocks(items, item_column, item_text_column)]
    return reduce(DataFrame.union, found).withColumnsRenamed({"_id": id_column, "_item": item_column})
