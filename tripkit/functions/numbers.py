"""Decimal rounding of doubles inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int) -> Column:
    """Round the scaled double to the nearest whole number, halves to even.

    Array libraries round this way. It stays in primitive arithmetic, while the built-in
    ``round`` goes through a decimal text per value.
    """
    scale = F.lit(float(10 ** digits))
    return F.rint(value * scale) / scale
