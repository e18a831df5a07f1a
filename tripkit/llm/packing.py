"""Best-fit packing of tokenised documents into sequences of a fixed length.

Every partition packs its own items best-fit, longest first. Sequences that are nearly full are
final. The others go on as single items: a round merges the leftovers of ``FAN_IN`` partitions
and packs them best-fit again, until one partition is left or a round joins hardly anything.
No task takes more than ``TASK_ITEMS`` leftovers on average, so a table of items that cannot be
joined never gathers in one place.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.llm.columnar import typed
from tripkit.llm.tokens import encoder
from tripkit.session import materialize

#: Free places of a sequence that counts as nearly full; partitions that a round merges into one.
SLACK, FAN_IN = 4, 8
#: Leftovers of one task on average, and items that a task packs at a time.
TASK_ITEMS, AT_ONCE = 50_000, 200_000
#: A round that joins fewer than this share of its items is the last.
LEAST_GAIN = 0.01


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """Pieces of a document's ids: piece, start, length, checksum, ids."""
    for piece, at in enumerate(range(0, len(ids), capacity * 4)):
        part = ids[at : at + capacity * 4]
        yield piece, at // 4, len(part) // 4, zlib.crc32(part), part


def piece_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    end = np.array([end_id], "<u4").tobytes()
    encode = encoder(path).encode
    for batch in batches:
        rows: list[int] = []
        cuts: list[tuple] = []
        for k, text in enumerate(batch.column(1)):
            found = list(cut(encode(text.as_py()) + end, capacity))
            rows.extend([k] * len(found))
            cuts.extend(found if keep_ids else [c[:4] for c in found])
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 if keep_ids else 4]
        columns = zip(*cuts, strict=True) if cuts else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
            names=["_id", "piece", "start", "length", "ids_crc32", "ids"][: len(kinds) + 1])


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_column: str = "doc_id",
           text_column: str = "text", keep_ids: bool = True) -> DataFrame:
    """Per document its ids and the end id, cut into pieces of ``capacity``; the last may be shorter.

    Returns id, piece, start, length, ids_crc32 and, if kept, ids (little-endian 32-bit). A null
    text is empty: one piece that holds the end id. Ids of documents only pass through.
    """
    texts = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    schema = typed(docs, id_column, "piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if keep_ids else ""))
    return texts.mapInArrow(
        partial(piece_batches, path=tokenizer, end_id=end_id, capacity=capacity, keep_ids=keep_ids),
        schema).withColumnRenamed("_id", id_column)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items of each bin: longest first, each into the fullest bin that still has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set while some bin has r places left
    for item in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        fitting = rooms >> lengths[item]
        if fitting:
            room = lengths[item] + (fitting & -fitting).bit_length() - 1
            held = by_room[room]
            chosen = held.pop()
            if not held:
                rooms ^= 1 << room
        else:
            room, chosen = max(capacity, lengths[item]), len(bins)
            bins.append([])
        bins[chosen].append(item)
        room -= lengths[item]
        by_room.setdefault(room, []).append(chosen)
        rooms |= 1 << room
    return bins


BINS = "items array<bigint>, lengths array<bigint>, total bigint, done boolean"


def packed_batches(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """Bins (items, lengths) packed into fuller bins, within the partition."""
    items: list[list[int]] = []
    lengths: list[list[int]] = []

    def flush() -> pa.RecordBatch:
        merged = best_fit([sum(x) for x in lengths], capacity)
        joined = [[i for m in b for i in items[m]] for b in merged]
        sizes = [[n for m in b for n in lengths[m]] for b in merged]
        totals = [sum(x) for x in sizes]
        long_list = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(joined, long_list), pa.array(sizes, long_list), pa.array(totals, pa.int64()),
             pa.array([t >= capacity - SLACK for t in totals], pa.bool_())], names=["items", "lengths", "total", "done"])

    for batch in batches:
        items.extend(batch.column(0).to_pylist())
        lengths.extend(batch.column(1).to_pylist())
        if len(items) >= AT_ONCE:
            yield flush()
            items, lengths = [], []
    if items:
        yield flush()


def placed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items of each bin with the bin's number and their places in it."""
    for batch in batches:
        numbers = batch.column(0).to_pylist()
        items, lengths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        out = [(i, number, at) for number, own, sizes in zip(numbers, items, lengths, strict=True)
               for i, at in zip(own, np.r_[0, np.cumsum(sizes)[:-1]].tolist(), strict=True)]
        columns = zip(*out, strict=True) if out else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "sequence_id", "offset"])


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """(item, sequence_id, offset) for the items (item bigint, length bigint) of ``items``.

    Items are not split; one longer than ``capacity`` gets a sequence of its own. Sequence ids
    are unique, offsets run from 0 without gaps. ``items`` must be stored: it is read once.
    """
    pack_partition = partial(packed_batches, capacity=capacity)
    alone = items.where(F.col("length") >= capacity - SLACK).select(
        F.array("item").alias("items"), F.array("length").alias("lengths"), F.col("length").alias("total"), F.lit(True).alias("done"))
    rest = items.where(F.col("length") < capacity - SLACK).select(F.array("item").alias("items"), F.array("length").alias("lengths"))
    finished = [alone]
    n, before = max(1, rest.rdd.getNumPartitions()), None
    while True:
        bins = materialize(rest.mapInArrow(pack_partition, BINS))
        finished.append(bins.where("done"))
        left = bins.where("NOT done").count()
        if n == 1 or not left or (before is not None and left > (1 - LEAST_GAIN) * before):
            finished.append(bins.where("NOT done"))
            break
        n = min(n - 1, max(math.ceil(n / FAN_IN), math.ceil(left / TASK_ITEMS)))
        before = left
        rest = bins.where("NOT done").select("items", "lengths").repartition(n)
    sequences = finished[0]
    for more in finished[1:]:
        sequences = sequences.union(more)
    numbered = sequences.select(F.monotonically_increasing_id().alias("sequence_id"), "items", "lengths")
    return numbered.mapInArrow(placed_batches, "item bigint, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, id_column: str = "doc_id",
                   text_column: str = "text", keep_ids: bool = True) -> DataFrame:
    """The pieces of all documents (see ``pieces``) with sequence_id and offset.

    Equal rows are packed as often as they occur; null ids and extra columns make no difference.
    An empty table gives no rows.
    """
    cut_up = materialize(pieces(docs, tokenizer, end_id, capacity, id_column, text_column, keep_ids)
                         .withColumn("_item", F.monotonically_increasing_id()))
    places = pack(cut_up.select(F.col("_item").alias("item"), "length"), capacity)
    return cut_up.join(places, cut_up["_item"] == places["item"]).drop("_item", "item")
