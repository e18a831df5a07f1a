"""Suffix-array deduplication of byte strings that occur more than once.

A corpus has no suffix array that fits a task, so only suffixes that can match are brought
together. In each string of ``length`` bytes the 64-byte gram with the least hash is its anchor:
equal strings have equal anchors at equal places, and neighbours mostly share theirs. Anchors
are counted across the table (see ``exchange``). Strings whose anchor occurs once are unique;
the others travel, as stretches of text, to the task of their anchor, each distinct stretch once
per chunk. That task sorts the suffixes and takes their longest-previous-factor array: a string
whose factor reaches ``length`` has an earlier copy, which is its source.

An anchor with very many distinct stretches is not given to one task: its strings are dealt out
by hashes of the strings themselves, combined before the shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.llm.columnar import buffers, keyed_texts, long_array, merge_spans, per_group, pieces, row_keys, runs, typed
from tripkit.llm.exchange import STEP_BYTES, ddl, repeated_places, table
from tripkit.llm.hashing import BYTE_BASE, WORD_BASES, mix, prefix_sums, spans_hash
from tripkit.llm.suffixes import longest_previous
from tripkit.session import materialize

#: Bytes of a gram that may be an anchor.
GRAM = 64
#: Distinct stretches of one anchor that one task may sort together; stretches it sorts at a time, in bytes.
CROWD, AT_ONCE = 8_000, 1 << 20
#: Bytes of text per bucket of anchors.
BUCKET_BYTES = 32 << 20
#: Longest text whose anchors are sought in one go; longer ones are taken in overlapping sections.
SECTION = 1 << 23

OCCURRENCE = np.dtype([("rank", "<i8"), ("key_a", "<i8"), ("key_b", "<i8"), ("start", "<i8")])
STRETCHES = pa.schema([("anchor", pa.int64()), ("content", pa.binary()), ("places", pa.binary())])
SPANS = pa.schema([("_key_a", pa.int64()), ("_key_b", pa.int64()), ("span", pa.binary())])
KEPT = pa.schema([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.binary()), ("kept", pa.binary())])


def anchored(data: np.ndarray, limits: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each string of ``length`` within one text, and its anchor's first byte."""
    section = max(SECTION, 4 * length)
    if len(data) > section:  # a text this long stands alone
        parts = [anchored(data[s : s + section], np.array([0, min(section, len(data) - s)]), length) for s in
                 range(0, len(data) - length + 1, section - length + 1)]
        shifts = range(0, len(data) - length + 1, section - length + 1)
        return tuple(np.concatenate([p[k] + s for p, s in zip(parts, shifts, strict=True)]) for k in (0, 1))
    gram = min(GRAM, length)
    width, n = length - gram + 1, len(data) - gram + 1
    text = np.repeat(np.arange(len(limits) - 1), np.diff(limits))
    starts = np.flatnonzero(np.arange(len(data)) + length <= limits[text + 1])
    if not len(starts):
        return starts, starts
    grams = np.arange(n)
    sums = prefix_sums(data.astype(np.uint64) + np.uint64(1), BYTE_BASE)
    keys = mix(spans_hash(sums, grams, grams + gram, BYTE_BASE)) >> np.uint64(24) << np.uint64(24) | grams.astype(np.uint64)
    padded = np.full(-(-n // width) * width, ~np.uint64(0))
    padded[:n] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[starts], ahead[starts + width - 1])
    return starts, (least & np.uint64((1 << 24) - 1)).astype(np.int64)


def gram_hashes(data: np.ndarray, at: np.ndarray, gram: int, base: int) -> np.ndarray:
    return mix(spans_hash(prefix_sums(data.astype(np.uint64) + np.uint64(1), base), at, at + gram, base))


def hashed_anchors(data: np.ndarray, limits: np.ndarray, length: int) -> tuple:
    at = np.unique(anchored(data, limits, length)[1])
    gram = min(GRAM, length)
    sent, chooser = (gram_hashes(data, at, gram, base) if len(at) else np.zeros(0, np.uint64) for base in WORD_BASES)
    text = np.searchsorted(limits, at, "right") - 1
    return at - limits[text], text, sent, chooser, np.diff(limits)


def stretch_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Stretches of strings with a repeated anchor: each distinct one once, with its places."""
    for batch in batches:
        data, limits = buffers(batch.column(batch.schema.get_field_index("_text")))
        rank, key_a, key_b = (long_array(batch.column(batch.schema.get_field_index(c))) for c in ("_rank", "_key_a", "_key_b"))
        marks = batch.column(batch.schema.get_field_index("_runs"))
        for first, last in pieces(limits, STEP_BYTES):
            block, part = data[limits[first] : limits[last]], limits[first : last + 1] - limits[first]
            held: dict[tuple[int, bytes], list[tuple]] = defaultdict(list)
            starts, anchors = anchored(block, part, length)
            marked = np.zeros(len(block) + 1, np.int8)
            for k in range(first, last):
                pairs = np.frombuffer(marks[k].as_buffer(), "<i4").reshape(-1, 2) + part[k - first]
                np.add.at(marked, pairs[:, 0], 1)
                np.add.at(marked, pairs[:, 1] + 1, -1)
            kept = np.cumsum(marked)[anchors] > 0 if len(anchors) else np.zeros(0, bool)
            starts, anchors = starts[kept], anchors[kept]
            if len(starts):
                new = np.flatnonzero(np.r_[True, (anchors[1:] != anchors[:-1]) | (np.diff(starts) > 1)])
                text = np.searchsorted(part, starts[new], "right") - 1
                hashes = gram_hashes(block, anchors[new], min(GRAM, length), WORD_BASES[0]).view(np.int64)
                ends = starts[np.r_[new[1:] - 1, len(starts) - 1]] + length
                for s, e, t, h in zip(starts[new].tolist(), ends.tolist(), text.tolist(), hashes.tolist(), strict=True):
                    k = first + t
                    held[h, block[s:e].tobytes()].append((rank[k], key_a[k], key_b[k], s - part[t]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in held], pa.int64()), pa.array([c for _, c in held], pa.binary()),
                 pa.array([np.array(p, OCCURRENCE).tobytes() for p in held.values()], pa.binary())], schema=STRETCHES)


def found_spans(repeated: np.ndarray, places: np.ndarray, length: int, rows: list[tuple]) -> None:
    """Adds the spans of a stretch's repeated strings, for each place it stands at."""
    first, last = runs(np.flatnonzero(repeated))
    for place in places:
        spans = np.stack([first, last + length], 1) + int(place["start"])
        rows.append((int(place["key_a"]), int(place["key_b"]), spans.astype("<i8").tobytes()))


def sorted_out(group: pa.Table, length: int, keep_first: bool) -> pa.Table:
    """Spans of repeated strings among the stretches of a bucket of anchors."""
    held: dict[tuple[int, bytes], list[np.ndarray]] = defaultdict(list)
    for anchor, content, places in zip(*(group.column(c) for c in ("anchor", "content", "places")), strict=True):
        held[anchor.as_py(), content.as_py()].append(np.frombuffer(places.as_buffer(), OCCURRENCE))
    by_anchor: dict[int, list[tuple[bytes, np.ndarray]]] = defaultdict(list)
    for (anchor, content), parts in held.items():
        by_anchor[anchor].append((content, np.sort(np.concatenate(parts), order=OCCURRENCE.names)))
    rows: list[tuple] = []
    batch: list[tuple[bytes, np.ndarray]] = []
    size = 0
    for stretches in by_anchor.values():
        if len(stretches) == 1:  # equal strings have equal anchors: none but its own copies can match
            content, places = stretches[0]
            if len(places) > 1:
                found_spans(np.ones(len(content) - length + 1, bool), places[1:] if keep_first else places, length, rows)
            continue
        batch.extend(stretches)
        size += sum(len(c) for c, _ in stretches)
        if size >= AT_ONCE:
            sort_batch(batch, length, keep_first, rows)
            batch, size = [], 0
    sort_batch(batch, length, keep_first, rows)
    return table(rows, SPANS)


def sort_batch(stretches: list[tuple[bytes, np.ndarray]], length: int, keep_first: bool, rows: list[tuple]) -> None:
    if not stretches:
        return
    stretches.sort(key=lambda s: tuple(s[1][0]))  # the order of first places, so that earlier text stands first
    sizes = np.array([len(c) for c, _ in stretches])
    bases = np.r_[0, np.cumsum(sizes)]
    counts = sizes - length + 1
    firsts = np.r_[0, np.cumsum(counts)]
    starts = np.arange(firsts[-1]) + np.repeat(bases[:-1] - firsts[:-1], counts)
    data = np.frombuffer(b"".join(c for c, _ in stretches), np.uint8)
    previous, source = longest_previous(data, starts, length)
    later = previous >= length
    repeated = later.copy()
    repeated[np.searchsorted(starts, source[later])] = True
    for k, (_, places) in enumerate(stretches):
        own = slice(firsts[k], firsts[k + 1])
        every = np.ones(counts[k], bool)
        if keep_first:
            found_spans(later[own], places[:1], length, rows)
            found_spans(every, places[1:], length, rows)
        else:
            found_spans(every if len(places) > 1 else repeated[own], places, length, rows)


STRINGS = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("n", pa.int64()), ("rank", pa.int64()), ("_key_a", pa.int64()),
                     ("_key_b", pa.int64()), ("start", pa.int64()), ("places", pa.binary())])


def string_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every string of crowded stretches: two hashes, how often it stands there, its first place and all places."""
    for batch in batches:
        for content, places in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("content", "places")), strict=True):
            data = np.frombuffer(content.as_buffer(), np.uint8)
            at = np.arange(len(data) - length + 1)
            held = np.sort(np.frombuffer(places.as_buffer(), OCCURRENCE), order=OCCURRENCE.names)
            n, first = len(at), held[0]
            columns = [gram_hashes(data, at, length, base).view(np.int64) for base in WORD_BASES]
            columns += [np.full(n, v, np.int64) for v in (len(held), first["rank"], first["key_a"], first["key_b"])] + [at + int(first["start"])]
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array([held.tobytes()] * n, pa.binary())], schema=STRINGS)


def string_spans(batches: Iterator[pa.RecordBatch], length: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Spans of the repeated strings: at every place, or at all but the first."""
    for batch in batches:
        rows = []
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("start", "places", "first"))
        for start, places, first in zip(*columns, strict=True):
            held = np.frombuffer(places, OCCURRENCE)
            shift = start - int(held[0]["start"])
            for place in held:
                at = int(place["start"]) + shift
                if not (keep_first and (place["rank"], place["key_a"], place["key_b"], at) == tuple(first.values())):
                    rows.append((int(place["key_a"]), int(place["key_b"]), np.array([at, at + length], "<i8").tobytes()))
        yield table(rows, SPANS).combine_chunks().to_batches()[0] if rows else pa.RecordBatch.from_pylist([], SPANS)


def kept_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns: list[list] = [[], [], [], []]
        for text, found in zip(batch.column("_text"), batch.column("_spans"), strict=True):
            data = text.as_py()
            spans = np.frombuffer(b"".join(found.as_py() or []), "<i8").reshape(-1, 2)
            starts, ends = merge_spans(spans[:, 0], spans[:, 1])
            cuts = [0, *np.stack([starts, ends], 1).ravel().tolist(), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
            for column, value in zip(columns, (len(data), len(data) - len(kept), np.stack([starts, ends], 1).astype("<i8").tobytes(), kept), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([batch.column("_id"), *(pa.array(c, f.type) for c, f in zip(columns, KEPT, strict=True))],
                                         names=["_id", *KEPT.names])


def remove_repeated_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 400,
                          keep_first: bool = False, crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, spans, kept.

    Every byte of a string of ``length`` bytes (8 or more) that starts at two places or more goes,
    or, with ``keep_first``, at all places but the first in the order of id and offset. ``spans`` holds
    int64 pairs [first byte, end) of the maximal removed runs, ``kept`` the other bytes. Strings are judged
    on the input and never cross texts. A null text is empty; texts shorter than ``length`` stay.
    Ids must cast to bigint where ``keep_first`` orders by them; null ids come first. Equal rows
    are places of their own, except that ``keep_first`` cannot tell them apart. Other columns are not read.
    """
    texts = keyed_texts(docs, id_column, text_column)
    ranked = docs.select(*row_keys(id_column, text_column), F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("_text"),
                         F.coalesce(F.expr(f"try_cast(`{id_column}` AS bigint)"), F.lit(-(1 << 63))).alias("_rank"))
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    marks = repeated_places(texts, partial(hashed_anchors, length=length), 2 * size // max(1, length - min(GRAM, length) + 2))
    marks = marks.groupBy("_key_a", "_key_b").agg(F.max("_runs").alias("_runs"))
    stretches = materialize(ranked.join(marks, ["_key_a", "_key_b"]).mapInArrow(partial(stretch_batches, length=length), ddl(STRETCHES)))
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    # eight bytes for every ``crowd`` stretches at most: broadcast, so that the stretches stay where they are
    crowded = F.broadcast(stretches.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > crowd).select("anchor"))
    few = stretches.join(crowded, "anchor", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(n)))
    spans = per_group(few, "bucket", sorted_out, ddl(SPANS), length=length, keep_first=keep_first)
    strings = stretches.join(crowded, "anchor", "left_semi").mapInArrow(partial(string_batches, length=length), ddl(STRINGS))
    repeated = strings.groupBy("h", "g").agg(F.sum("n").alias("times"), F.min(F.struct("rank", "_key_a", "_key_b", "start")).alias("first")).where("times > 1")
    many = strings.join(repeated, ["h", "g"]).select("start", "places", "first").mapInArrow(
        partial(string_spans, length=length, keep_first=keep_first), ddl(SPANS))
    by_text = spans.union(many).groupBy("_key_a", "_key_b").agg(F.collect_list("span").alias("_spans"))
    joined = texts.join(by_text, ["_key_a", "_key_b"], "left").select("_id", "_text", "_spans")
    return joined.mapInArrow(kept_bytes, typed(docs, id_column, ddl(KEPT))).withColumnRenamed("_id", id_column)
