"""Reproducible samples and head rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.functions.keys import row_hash
from tripkit.operators.selection import group_ranges, select_ranks
from tripkit.schema import ROW_ORDER, SEED


def smallest(df: DataFrame, column: str, n: int, tie: Column) -> DataFrame:
    """The ``n`` rows of the smallest values of a whole-number column, equal ones by ``tie``.

    The value of the last such row is found by counting, so no task takes in rows of all others.
    """
    ranges = group_ranges(df, [column])
    if n < 1 or not ranges:
        return df.limit(0)
    key = (column,)
    if ranges[key]["n"] <= n:
        return df.where(F.col(column).isNotNull())
    last = select_ranks(df, [column], {key: [n - 1]}, ranges)[key, n - 1]
    if last.below + last.equal == n:
        return df.where(F.col(column) <= last.value)
    ties = df.where(F.col(column) == last.value).orderBy(tie).limit(n - last.below)
    return df.where(F.col(column) < last.value).unionByName(ties)


def seeded_sample(df: DataFrame, key: Column, n: int, seed: int = SEED) -> DataFrame:
    """``min(n, rows)`` rows without replacement: the ``n`` smallest row hashes.

    The sample is the same under any partitioning. ``key`` should be unique.
    """
    hashed = df.withColumns({"__hash": row_hash(key, seed), "__key": key})
    return smallest(hashed, "__hash", n, F.col("__key")).drop("__hash", "__key")


def head_rows(df: DataFrame, n: int, order: str = ROW_ORDER) -> DataFrame:
    """The first ``n`` rows in input order, sorted."""
    return smallest(df, order, n, F.col(order)).orderBy(order)
