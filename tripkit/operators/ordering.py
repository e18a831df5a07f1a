"""Global row numbers in a given order, without gathering rows in one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.session import materialize


def numbered(df: DataFrame, *order: str | Column) -> DataFrame:
    """``df`` with its row number from 0 in ``order`` as _pos.

    Rows are dealt out by range, sorted within partitions and written once. What the driver
    holds is one count per partition. Rows that tie in ``order`` are numbered as they come,
    once and for all.
    """
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", 33)
    counts = sorted((r.part, r.n) for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    firsts = accumulate([0, *(n for _, n in counts)])
    offsets = placed.sparkSession.createDataFrame(
        [(p, first - (p << 33)) for (p, _), first in zip(counts, firsts, strict=False)], "_part bigint, _offset bigint")
    return placed.join(F.broadcast(offsets), part == F.col("_part")).withColumn(
        "_pos", F.col("_row") + F.col("_offset")).drop("_row", "_part", "_offset")
