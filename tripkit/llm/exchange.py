"""Find hash values that occur more than once in a whole table, without a row per value.

Every task packs the values of a chunk of texts into one block per bucket (a bucket is a
range of values), so the shuffle carries 8 bytes per distinct value of a chunk plus about
one for its place. A value that repeats within a chunk, however often, is sent once: no key
can be hot. Each bucket is sorted in one task and answers every chunk with the places of its
values that other chunks hold too. Buckets are as many as the data need; chunks have a fixed
size. Two hashes are taken of everything: one is sent, the other chooses the bucket, so values
count as equal on 64 + log2(buckets) bits.

The texts must come in the same order if a lost task runs again, as they do from stored
files. A chunk is named by its texts; should a second run of a task give other chunks, their
places would miss the lists of texts they belong to, and the job fails rather than lose links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tripkit.llm.columnar import buffers, long_array, pack, pieces, runs, unpack

#: Bytes of text whose values a task packs together, and that it hashes at a time.
CHUNK_BYTES, STEP_BYTES = 16 << 20, 1 << 20
#: Values that one bucket may hold on average.
BUCKET_VALUES = 3_000_000

BLOCKS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int8()),
                    ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
BLOCK, MANIFEST, ANSWER = 0, 1, 2
FOUND = pa.schema([("_key_a", pa.int64()), ("_key_b", pa.int64()), ("_runs", pa.binary())])

#: (bytes, limits of texts) -> (place in its text, text, sent value, bucket value) per hashed item,
#: ordered by text and place, and the number of places of each text.
Hasher = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def repeated_places(texts: DataFrame, hasher: Hasher, n_values: int) -> DataFrame:
    """Per text that has any, the places whose value occurs at two places or more of the table.

    ``texts`` has _key_a, _key_b, _text (see ``keyed_texts``); ``n_values`` estimates the number
    of values. Returns _key_a, _key_b, and _runs: int32 pairs (first, last) of consecutive places.
    """
    setting = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(setting, -(-n_values // BUCKET_VALUES))

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(batches, hasher, n)

    blocks = texts.select("_key_a", "_key_b", "_text").mapInArrow(block, ddl(BLOCKS))
    answers = blocks.repartition(n, "bucket").groupBy("bucket").applyInArrow(compared, ddl(BLOCKS))
    return answers.groupBy("chunk").applyInArrow(gathered, ddl(FOUND))


def ddl(schema: pa.Schema) -> str:
    names = {pa.int8(): "tinyint", pa.int32(): "int", pa.int64(): "bigint", pa.binary(): "binary",
             pa.string(): "string", pa.float64(): "double", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


class Chunk:
    """Values of the texts gathered so far."""

    def __init__(self) -> None:
        self.size, self.places = 0, 0
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.items: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, size: int, found: tuple) -> None:
        place, text, sent, chooser, counts = found
        first = self.places + np.r_[0, np.cumsum(counts)]
        self.items.append(((first[text] + place).astype(np.int32), sent, chooser))
        self.keys.append(keys)
        self.counts.append(counts.astype(np.int32))
        self.size, self.places = self.size + size, int(first[-1])

    def rows(self, n: int) -> Iterator[pa.RecordBatch]:
        place, sent, chooser = (np.concatenate(x) for x in zip(*self.items, strict=True))
        keys = np.concatenate(self.keys).astype("<i8").tobytes()
        name = xxhash.xxh64_intdigest(keys) >> 1
        bucket = (chooser % np.uint64(n)).astype(np.uint16 if n <= 1 << 16 else np.int32)
        order = np.argsort(sent)
        same = (sent[order][1:] == sent[order][:-1]) & (bucket[order][1:] == bucket[order][:-1])
        repeated, first = np.zeros((2, len(order)), bool)
        if len(order):
            repeated[order] = np.r_[False, same] | np.r_[same, False]
        first[order] = np.r_[np.ones(min(1, len(order)), bool), ~same]
        yield record(name % n, name, MANIFEST, keys, np.concatenate(self.counts).tobytes(), pack(place[repeated]))
        place, sent, bucket = place[first], sent[first], bucket[first]
        order = np.argsort(bucket, kind="stable")  # within a bucket the places keep rising
        place, sent = place[order], sent[order]
        limits = np.searchsorted(bucket[order], np.arange(n + 1))
        for b in range(n):
            lo, hi = limits[b], limits[b + 1]
            if lo < hi:
                yield record(b, name, BLOCK, sent[lo:hi].astype("<u8").tobytes(), pack(place[lo:hi]), b"")


def record(bucket: int, chunk: int, kind: int, a: bytes, b: bytes, c: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((bucket, chunk, kind, a, b, c), BLOCKS, strict=True)],
                                      schema=BLOCKS)


def packed(batches: Iterator[pa.RecordBatch], hasher: Hasher, n: int) -> Iterator[pa.RecordBatch]:
    chunk = Chunk()
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([long_array(batch.column(0)), long_array(batch.column(1))], 1)
        data, limits = buffers(batch.column(2))
        for first, last in pieces(limits, STEP_BYTES):
            part = limits[first : last + 1]
            chunk.add(keys[first:last], int(part[-1] - part[0]), hasher(data[part[0] : part[-1]], part - part[0]))
            if chunk.size >= CHUNK_BYTES:
                yield from chunk.rows(n)
                chunk = Chunk()
    if chunk.keys:
        yield from chunk.rows(n)


def compared(group: pa.Table) -> pa.Table:
    """Of one bucket: each chunk's places whose value another chunk has too."""
    kinds = np.asarray(group.column("kind"))
    out = [group.filter(pa.array(kinds == MANIFEST)).cast(BLOCKS)]
    blocks = group.filter(pa.array(kinds == BLOCK))
    if blocks.num_rows:
        sent = [np.frombuffer(x.as_buffer(), "<u8") for x in blocks.column("a")]
        owner = np.repeat(np.arange(len(sent), dtype=np.int32), [len(x) for x in sent])
        values = np.concatenate(sent)
        order = np.argsort(values, kind="stable")
        same = values[order][1:] == values[order][:-1]
        hits = np.zeros(len(values), bool)
        hits[order] = np.r_[False, same] | np.r_[same, False]
        limits = np.searchsorted(owner, np.arange(len(sent) + 1))
        rows = []
        for k, (chunk, places) in enumerate(zip(blocks.column("chunk").to_pylist(), blocks.column("b"), strict=True)):
            hit = hits[limits[k] : limits[k + 1]]
            if hit.any():
                rows.append((0, chunk, ANSWER, b"", b"", pack(unpack(places.as_buffer())[hit])))
        out.append(table(rows, BLOCKS))
    return pa.concat_tables(out)


def table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def gathered(group: pa.Table) -> pa.Table:
    """Of one chunk: its own repeats and the buckets' answers, dealt out to its texts."""
    kinds = np.asarray(group.column("kind"))
    lists = group.filter(pa.array(kinds == MANIFEST))
    if not lists.num_rows:
        raise RuntimeError("a task that ran again met its texts in another order; read them from stored files")
    keys = np.frombuffer(lists.column("a")[0].as_buffer(), "<i8").reshape(-1, 2)
    limits = np.r_[0, np.cumsum(np.frombuffer(lists.column("b")[0].as_buffer(), np.int32), dtype=np.int64)]
    places = np.unique(np.concatenate([unpack(x.as_buffer()) for x in group.column("c")]))
    cuts = np.searchsorted(places, limits)
    rows = []
    for k in np.flatnonzero(np.diff(cuts)):
        first, last = runs(places[cuts[k] : cuts[k + 1]] - limits[k])
        rows.append((int(keys[k, 0]), int(keys[k, 1]), np.stack([first, last], 1).astype("<i4").tobytes()))
    return table(rows, FOUND)
