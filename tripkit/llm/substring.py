"""Substring deduplication: remove every word of a window that occurs elsewhere.

Rabin-Karp hashes of all windows of ``window`` consecutive words are counted across the table
(see ``exchange``); the windows that start at two places or more, in one text or in several,
merge into maximal intervals of words, which are removed. Windows are judged on the input, so
every copy goes, the first one too, and so do overlapping ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.llm.columnar import keyed_texts, merge_spans, row_keys, typed
from tripkit.llm.exchange import ddl, repeated_places
from tripkit.llm.hashing import WORD_BASES, mix, windows_hash, word_values, words

KEPT = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.binary()), ("kept", pa.string())])


def hashed_windows(data: np.ndarray, limits: np.ndarray, window: int) -> tuple:
    """The windows of each text, by their first word."""
    starts, ends, first = words(data, limits)
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(np.arange(len(starts)) + window <= first[text + 1]) if len(starts) else starts
    values = word_values(data, starts, ends) if len(at) else np.zeros(0, np.uint64)
    sent, chooser = (mix(windows_hash(values, at, window, base)) if len(at) else values for base in WORD_BASES)
    return at - first[text[at]], text[at], sent, chooser, counts


def kept_words(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Each text without its repeated windows, its words joined by one space; the first column stays."""
    for batch in batches:
        columns: list[list] = [[], [], [], []]
        for text, found in zip(batch.column("_text"), batch.column("_runs"), strict=True):
            parts = text.as_py().split()
            n = len(parts)
            spans = np.zeros((0, 2), np.int32)
            if found.is_valid:
                firsts = np.frombuffer(found.as_buffer(), "<i4").reshape(-1, 2).astype(np.int64)
                spans = np.stack(merge_spans(firsts[:, 0], firsts[:, 1] + window), 1)
                for s, e in spans[::-1]:
                    del parts[s:e]
            for column, value in zip(columns, (n, n - len(parts), spans.astype("<i4").tobytes(), b" ".join(parts).decode()), strict=True):
                column.append(value)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, KEPT, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), *arrays], names=["_id", *KEPT.names])


def kept_of(texts: DataFrame, size: int, window: int) -> DataFrame:
    """_id and the columns of ``KEPT`` for rows of _id, _key_a, _key_b, _text; ``size`` is the text's bytes."""
    found = repeated_places(texts, partial(hashed_windows, window=window), size // 6)
    found = found.groupBy("_key_a", "_key_b").agg(F.max("_runs").alias("_runs"))
    joined = texts.join(found, ["_key_a", "_key_b"], "left").select("_id", "_text", "_runs")
    return joined.mapInArrow(partial(kept_words, window=window), typed(texts, "_id", ddl(KEPT)))


def text_bytes(docs: DataFrame, text_column: str) -> int:
    return docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0


def remove_repeated_windows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                            window: int = 35) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, spans, kept.

    ``spans`` holds int32 pairs [first word, end word) of the maximal removed intervals, ``kept``
    the remaining words joined by one space. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A null
    text has no words; a text of fewer than ``window`` words loses none. Ids only pass through:
    null or repeated ids make no difference, and of equal rows each counts as a place of its own.
    Other columns of ``docs`` are not read. Memory of a task grows with its longest single text.
    """
    kept = kept_of(keyed_texts(docs, id_column, text_column), text_bytes(docs, text_column), window)
    return kept.withColumnRenamed("_id", id_column)


def without_repeated_windows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = 35) -> DataFrame:
    """``docs`` with the repeated windows taken out of its texts; texts that lose nothing stay as they are.

    A document that loses every word goes. All other columns stay, whatever their names.
    """
    texts = docs.select(F.struct("*").alias("_id"), *row_keys(id_column, text_column),
                        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("_text"))
    kept = kept_of(texts, text_bytes(docs, text_column), window).where("n_removed = 0 OR kept <> ''")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("_id").getField(text_column))
    return kept.select(*(text.alias(c) if c == text_column else F.col("_id").getField(c).alias(c) for c in docs.columns))
