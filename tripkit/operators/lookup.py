"""Joins of a large table to a lookup table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi-join to a lookup whose keys are unique; null keys match null keys.

    Whether the lookup is broadcast is left to Spark, which knows its size in bytes. Since each
    key has one lookup row, adaptive execution can split the partition of a hot key on the
    large side, and nothing is multiplied.
    """
    renamed = lookup.withColumnsRenamed({c: f"__{c}" for c in on})
    condition = None
    for c in on:
        same = df[c].eqNullSafe(renamed[f"__{c}"])
        condition = same if condition is None else condition & same
    return df.join(renamed, condition, how).drop(*[f"__{c}" for c in on])
