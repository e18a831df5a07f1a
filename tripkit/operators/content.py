"""Content hash of a table, independent of row order and partitioning."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEPARATOR = "|"
NULL_MARK = "-"  # no cell begins with it: cells begin with their length


def canonical(df: DataFrame, column: str) -> Column:
    """Exact text of a cell behind its length, so that no two rows of cells read the same.

    Decimals are written digit by digit, doubles with the fewest digits that tell them apart.
    """
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        epoch = F.lit("1970-01-01 00:00:00").cast(kind)
        text = F.timestamp_diff("MICROSECOND", epoch, value).cast("string")
    elif isinstance(kind, T.DateType):
        text = F.unix_date(value).cast("string")
    elif isinstance(kind, (T.ArrayType, T.StructType)):
        text = F.to_json(value)
    else:
        text = value.cast("string")
    return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit(NULL_MARK))


def row_digest(df: DataFrame, columns: list[str] | None = None) -> Column:
    """60 bits of the md5 of a row's canonical text."""
    cells = [canonical(df, c) for c in columns or df.columns]
    return F.conv(F.substring(F.md5(F.concat(*cells)), 1, 15), 16, 10).cast("decimal(20,0)")


def digest_totals(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Row count and sum of row digests; equal multisets of rows give equal totals."""
    return df.select(row_digest(df, columns).alias("d")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(F.col("d").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("total"),
    )


def content_hash(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: ``n_rows`` and a 16-digit ``content_hash``."""
    return hash_of_totals(digest_totals(df, columns))


def merged_totals(totals: DataFrame) -> DataFrame:
    """Totals of a whole table from the totals of its parts; they add up."""
    return totals.agg(*(F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")), F.lit(0)).cast(kind).alias(c)
                        for c, kind in (("n_rows", "bigint"), ("total", "decimal(38,0)"))))


def hash_of_totals(totals: DataFrame) -> DataFrame:
    """``n_rows`` and ``content_hash`` for each row of ``digest_totals``."""
    text = F.concat_ws(SEPARATOR, F.col("n_rows").cast("string"), F.col("total").cast("string"))
    return totals.select("n_rows", F.substring(F.sha2(text, 256), 1, 16).alias("content_hash"))


def hash_text(df: DataFrame, columns: list[str] | None = None) -> str:
    return hash_of(digest_totals(df, columns).first())


def hash_of(row) -> str:
    """The hash that ``content_hash`` gives for a row of ``digest_totals``."""
    return hashlib.sha256(f"{row['n_rows']}{SEPARATOR}{row['total']}".encode()).hexdigest()[:16]
