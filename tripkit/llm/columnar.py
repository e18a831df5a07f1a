"""Arrow batches as numpy arrays, and packed integer lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def row_keys(id_column: str, text_column: str) -> list[Column]:
    """Two hashes of id and text: 128 bits that name a row; equal rows share them.

    The name holds for ids of any type, null and repeated ones too.
    """
    return [F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column)).alias(name)
            for seed, name in ((1, "_key_a"), (2, "_key_b"))]


def keyed_texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """_id, _key_a, _key_b and the text as UTF-8 bytes (null: empty); no other column."""
    return docs.select(F.col(id_column).alias("_id"), *row_keys(id_column, text_column),
                       F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("_text"))


def typed(df: DataFrame, column: str, rest: str, name: str = "_id") -> StructType:
    """Schema of a column of ``df``, whatever its type, called ``name``, and the columns that ``rest`` describes."""
    return StructType([StructField(name, df.schema[column].dataType), *(StructType.fromDDL(rest).fields if rest else [])])


def row_schema(df: DataFrame, first: str) -> StructType:
    """Schema of the columns that ``first`` describes, and of whole rows of ``df`` as _row."""
    return StructType([*StructType.fromDDL(first).fields, StructField("_row", df.schema)])


def row_columns(df: DataFrame, *, but: str = "") -> list[Column]:
    """The columns of ``df`` out of _row."""
    return [F.col("_row").getField(c).alias(c) for c in df.columns if c != but]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and limits of a binary or string array without nulls; limits start at 0."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    limits = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[limits[0] : limits[-1]], (limits - limits[0]).astype(np.int64)


def pieces(limits: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``most`` bytes together; a longer text stands alone."""
    first, n = 0, len(limits) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(limits, limits[first] + most, "right")) - 1)
        yield first, last
        first = last


def long_array(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def per_group(df: DataFrame, key: str | list[str], task: Callable[..., pa.Table], schema: str, **fixed: Any) -> DataFrame:
    """``task(group, **fixed)`` for the rows of each key."""

    def run(group: pa.Table) -> pa.Table:
        return task(group, **fixed)

    return df.groupBy(key).applyInArrow(run, schema)


def pack(rising: np.ndarray) -> bytes:
    """Rising integers as differences, in byte planes that a block compressor shortens."""
    steps = np.diff(rising, prepend=0).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


def runs(rising: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last member of each run of consecutive integers."""
    if not len(rising):
        return rising, rising
    breaks = np.flatnonzero(np.diff(rising) > 1)
    return rising[np.r_[0, breaks + 1]], rising[np.r_[breaks, len(rising) - 1]]


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as maximal spans; spans that touch become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.r_[True, starts[1:] > reach[:-1]]
    return starts[first], reach[np.r_[np.flatnonzero(first)[1:] - 1, len(starts) - 1]]
