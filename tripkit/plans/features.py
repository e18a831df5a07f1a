"""All row features in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.functions import geo, weather
from tripkit.functions.time import time_features
from tripkit.schema import COORDINATES


def assert_columns(df: DataFrame, columns: list[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")


def add_time_features(df: DataFrame, at: str = "pickup_datetime") -> DataFrame:
    assert_columns(df, [at])
    return df.withColumns(time_features(F.col(at)))


def add_location_features(df: DataFrame) -> DataFrame:
    assert_columns(df, COORDINATES)
    points = [F.col(c) for c in COORDINATES]
    # two steps, so that distance and bearing are computed once per row
    measured = df.withColumns(geo.distance_features(*points))
    return measured.withColumns(
        geo.location_features(*points, F.col("haversine_km"), F.col("bearing_deg"))
    )


def encode_store_flag(df: DataFrame) -> DataFrame:
    if "store_and_fwd_flag" not in df.columns:
        return df
    return df.withColumn("store_and_fwd_flag", weather.store_flag(F.col("store_and_fwd_flag")))


def add_weather_features(df: DataFrame) -> DataFrame:
    """Rain and snow flags, and the three weather values as 32-bit floats."""

    def value(name: str):
        return F.col(name) if name in df.columns else F.lit(0.0)

    flags = {
        "is_snowing": weather.is_snowing(value("snow_depth")),
        "is_raining": weather.is_raining(value("precipitation"), value("snow_depth")),
    }
    # the flags compare the full-precision values, so they are derived in the same step
    floats = {c: value(c).cast("float") for c in ("avg_temp_f", "precipitation", "snow_depth")}
    return df.withColumns({**flags, **floats})


def build_features(df: DataFrame) -> DataFrame:
    """Time, location, distance, flag and weather features; Catalyst fuses the steps."""
    return add_weather_features(
        encode_store_flag(add_location_features(add_time_features(df)))
    )


def new_columns(before: DataFrame, after: DataFrame) -> list[str]:
    return sorted(set(after.columns) - set(before.columns))
