"""Raw CSV readers with explicit schemas and null-on-error parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkit.functions.numbers import rounded
from tripkit.operators.sampling import head_rows
from tripkit.schema import ROW_ORDER, TRIP_RENAMES, WEATHER_RENAMES, WEATHER_SCHEMA

INTEGERS = ["passenger_count", "vendor_id"]
DOUBLES = ["pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", "eta_minutes"]
TIMES = ["pickup_datetime", "dropoff_datetime"]


def with_row_order(df: DataFrame) -> DataFrame:
    """Number the rows of a file scan from 0, by file name and then by place in the file.

    Spark packs files into tasks by size, so task numbers say nothing about file order. Rows of one
    split of a file stay together in a task; the driver counts the splits, a row each, and adds up
    the rows before every one.
    """
    placed = df.withColumns({"__file": F.col("_metadata.file_path"), "__block": F.col("_metadata.file_block_start"),
                             "__at": F.monotonically_increasing_id()})
    splits = placed.groupBy("__file", "__block").agg(F.min("__at").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    rows, before = [], 0
    for r in sorted(splits, key=lambda r: (r["__file"], r["__block"])):
        rows.append((r["__file"], r["__block"], before - r["first"]))
        before += r["n"]
    shifts = df.sparkSession.createDataFrame(rows, "__file string, __block bigint, __shift bigint")
    return placed.join(F.broadcast(shifts), ["__file", "__block"]).withColumn(
        ROW_ORDER, F.col("__at") + F.col("__shift")).select(*df.columns, ROW_ORDER)


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    for path in paths:
        try:
            spark.read.text(path)
            return path
        except AnalysisException:
            continue
    raise FileNotFoundError(f"none of {list(paths)} exists")


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, names from the header line, bad lines kept with nulls."""
    return spark.read.csv(path, header=True, mode="PERMISSIVE", inferSchema=False)


# --------------------------------------------------------------------- coercion


def to_double(value: Column) -> Column:
    """Number or null; text that is not a number and NaN become null."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def to_whole(value: Column) -> Column:
    """Whole number or null: '2.0' is 2, '2.7' is null."""
    number = to_double(value)
    return F.when(number == F.floor(number), number.try_cast("int"))


def to_time(value: Column) -> Column:
    """Zone-free timestamp or null."""
    return value.try_cast("timestamp_ntz")


def to_day(value: Column, pattern: str = "d-M-yyyy") -> Column:
    """Day-first date or null; one-digit days and months are accepted."""
    return F.to_date(F.try_to_timestamp(value, F.lit(pattern)))


def adapt_trips(raw: DataFrame) -> DataFrame:
    """Rename present columns and give each its type; absent columns are skipped.

    Without a duration column ``eta_minutes`` must already be there.
    """
    df = raw.withColumnsRenamed(TRIP_RENAMES)
    typed = {c: to_time(F.col(c)) for c in TIMES if c in df.columns}
    typed |= {c: to_whole(F.col(c)) for c in INTEGERS if c in df.columns}
    if "trip_duration_sec" in df.columns:
        typed["trip_duration_sec"] = to_double(F.col("trip_duration_sec")).try_cast("bigint")
        minutes = rounded(to_double(F.col("trip_duration_sec")) / 60, 4)
        df = df.withColumn("eta_minutes", minutes)
    typed |= {c: to_double(F.col(c)) for c in DOUBLES if c in df.columns}
    return df.withColumns(typed)


def adapt_weather(raw: DataFrame) -> DataFrame:
    """Normalise header names, parse day-first dates, coerce numbers; undated rows go."""
    df = raw.toDF(*[c.strip().lower() for c in raw.columns]).withColumnsRenamed(WEATHER_RENAMES)
    numbers = [f.name for f in WEATHER_SCHEMA.fields if isinstance(f.dataType, T.DoubleType)]
    typed = {c: to_double(F.col(c)) for c in numbers if c in df.columns}
    typed["date"] = to_day(F.col("date"))
    return df.withColumns(typed).na.drop(subset=["date"])


# ---------------------------------------------------------------------- sources


def read_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """Trips from the first of ``paths`` that exists; a missing file is an error."""
    return adapt_trips(with_row_order(read_text_csv(spark, first_existing(spark, paths))))


def read_weather(spark: SparkSession, path: str | None) -> DataFrame:
    """Daily weather, one row per date, first in file order; a missing file is an empty table."""
    from tripkit.operators.enrich import daily_weather

    try:
        raw = read_text_csv(spark, path) if path else None
    except AnalysisException:
        raw = None
    if raw is None:
        return spark.createDataFrame([], WEATHER_SCHEMA)
    return daily_weather(adapt_weather(with_row_order(raw)))


def write_head_csv(df: DataFrame, path: str, n: int, order: str = ROW_ORDER) -> None:
    """The first ``n`` rows in input order as a smaller CSV with a header."""
    head_rows(df, n, order).drop(order).write.csv(path, header=True, mode="errorifexists")
