"""Reproducible pseudo-random numbers per row, independent of partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13  # 52 bits, exact in a double as well as in a bigint
HASH_RANGE = 16 ** HEX_DIGITS


def row_hash(key: Column, seed: int) -> Column:
    """Uniform bigint in [0, 2^52) from the text of ``key`` and a seed."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(text), 1, HEX_DIGITS), 16, 10).cast("bigint")


def row_uniform(key: Column, seed: int) -> Column:
    """The same number scaled to [0, 1)."""
    return row_hash(key, seed) / F.lit(float(HASH_RANGE))
