"""Row features."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.quality import enriched
from catalogue.sql import (
    CYCLE_COLUMNS, DISTANCE, DOW, GEO_COLUMNS, GRID_COLUMNS, HOUR, MONTH, RUSH, STORE_FLAG, TIME_COLUMNS,
    WEATHER_COLUMNS, WEEKEND, using,
)
from tripkit.functions import geo, weather
from tripkit.operators import enrich
from tripkit.plans import features
from tripkit.plans.first_generation import attach_weather, coarse_features, with_speed
from tripkit.schema import FEATURE_ORDER
from tripkit.sources import derived

TIME = ["hour_of_day", "day_of_week", "month", "is_weekend", "is_rush_hour", "part_of_day"]
CYCLES = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]
GEO = ["haversine_km", "bearing_deg", "bearing_sin", "bearing_cos", "delta_lat", "delta_lon", "log_haversine_km"]
GRID = ["pickup_grid_x", "pickup_grid_y", "dropoff_grid_x", "dropoff_grid_y"]


def time_features(spark, sf):
    return features.add_time_features(derived.trips(spark, sf)).select("row_ord", *TIME)


def cyclical_features(spark, sf):
    return features.add_time_features(derived.trips(spark, sf)).select("row_ord", *CYCLES)


def geo_features(spark, sf):
    return features.add_location_features(derived.trips(spark, sf)).select("row_ord", *GEO)


def grid_cells(spark, sf):
    """Grid cells of every trip, null without a place; as doubles, which hold nulls in any reader."""
    cells = features.add_location_features(derived.trips(spark, sf))
    return cells.select("row_ord", *(F.col(c).cast("double").alias(c) for c in GRID))


def weather_flags(spark, sf):
    joined = enrich.join_weather(derived.trips(spark, sf), derived.weather(spark, sf))
    return features.add_weather_features(joined).select("row_ord", "is_snowing", "is_raining")


def weather_bands(spark, sf):
    return derived.weather(spark, sf).select(
        F.col("date").cast("string").alias("date"), weather.temperature_band(F.col("avg_temp_f")).alias("temp_band"),
        weather.rain_label(F.col("precipitation")).alias("rain"),
    )


def store_flag(spark, sf):
    return features.encode_store_flag(derived.trips(spark, sf)).select("row_ord", "store_and_fwd_flag")


def build_features(spark, sf):
    return features.build_features(enriched(spark, sf)).select("row_ord", *FEATURE_ORDER, "part_of_day", "eta_minutes")


def implied_speed(spark, sf):
    table = with_speed(coarse_features(derived.trips(spark, sf)))
    return table.select("row_ord", "implied_speed_kmh", "plausible_speed")


def coarse_columns(spark, sf):
    """Columns of the earlier job, with the daily weather in metric units carried along."""
    weather_day = derived.weather(spark, sf).select(
        "date", ((F.col("avg_temp_f") - 32.0) * 5.0 / 9.0).alias("temp_c"),
        (F.col("precipitation") * 25.4).alias("precip_mm"),
        weather.rain_label(F.col("precipitation")).alias("weather_condition"))
    table = attach_weather(coarse_features(derived.trips(spark, sf)), weather_day)
    return table.select(
        "row_ord", "hour_of_day", "day_of_week", "is_weekend", "month", "is_rush_hour", "trip_distance_km",
        F.col("trip_date").cast("string").alias("trip_date"), F.round("temp_c", 6).alias("temp_c"),
        F.round("precip_mm", 6).alias("precip_mm"), "weather_condition")


def weekday_names(spark, sf):
    from tripkit.functions.time import weekday_name

    return derived.trips(spark, sf).select("row_ord", weekday_name(F.col("pickup_datetime")).alias("weekday"))


def great_circle(spark, sf):
    points = [F.col(c) for c in ("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon")]
    return derived.trips(spark, sf).select("row_ord", F.round(geo.great_circle_km(*points), 4).alias("km"))


JOIN = "FROM trips t LEFT JOIN weather w ON w.date = CAST(t.pickup_datetime AS DATE)"
BAND = ("CASE WHEN avg_temp_f > 0 AND avg_temp_f <= 32 THEN 'Freezing (<32F)'"
        " WHEN avg_temp_f > 32 AND avg_temp_f <= 50 THEN 'Cold (32-50F)'"
        " WHEN avg_temp_f > 50 AND avg_temp_f <= 65 THEN 'Cool (50-65F)'"
        " WHEN avg_temp_f > 65 AND avg_temp_f <= 80 THEN 'Warm (65-80F)'"
        " WHEN avg_temp_f > 80 AND avg_temp_f <= 120 THEN 'Hot (>80F)' END")
SPEED = f"{DISTANCE} / nullif(trip_duration_sec / cast(60 as double) / cast(60 as double), 0)"

QUERIES = {
    "time_features": (time_features, using("trips", f"SELECT row_ord, {TIME_COLUMNS} FROM trips")),
    "cyclical_features": (cyclical_features, using("trips", f"SELECT row_ord, {CYCLE_COLUMNS} FROM trips")),
    "geo_features": (geo_features, using("trips", f"SELECT row_ord, {GEO_COLUMNS} FROM trips")),
    "great_circle": (great_circle, using("trips", f"SELECT row_ord, {DISTANCE} AS km FROM trips")),
    "grid_cells": (grid_cells, using("trips", f"""
        SELECT row_ord, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in GRID)} FROM (SELECT row_ord, {GRID_COLUMNS} FROM trips)""")),
    "weather_flags": (weather_flags, using("trips", f"SELECT row_ord, {WEATHER_COLUMNS} {JOIN}", "weather")),
    "weather_bands": (weather_bands, using("weather", f"""
        SELECT CAST(date AS VARCHAR) AS date, {BAND} AS temp_band,
               CASE WHEN precipitation > 0.1 THEN 'Rainy' ELSE 'Dry' END AS rain FROM weather""")),
    "store_flag": (store_flag, using("trips", f"SELECT row_ord, {STORE_FLAG} AS store_and_fwd_flag FROM trips")),
    "coarse_columns": (coarse_columns, using("trips", f"""
        SELECT row_ord, {HOUR} AS hour_of_day, {DOW} AS day_of_week, {WEEKEND} AS is_weekend, {MONTH} AS month,
               {RUSH} AS is_rush_hour, {DISTANCE} AS trip_distance_km,
               CAST(CAST(pickup_datetime AS DATE) AS VARCHAR) AS trip_date,
               round((avg_temp_f - 32) * 5 / 9, 6) AS temp_c, round(precipitation * cast(25.4 as double), 6) AS precip_mm,
               CASE WHEN precipitation > 0.1 THEN 'Rainy' WHEN w.date IS NOT NULL THEN 'Dry' END AS weather_condition
        {JOIN}""", "weather")),
    "weekday_names": (weekday_names, using("trips", "SELECT row_ord, dayname(pickup_datetime) AS weekday FROM trips")),
    "build_features": (build_features, using(
        "features", f"SELECT row_ord, {', '.join(FEATURE_ORDER)}, part_of_day, eta_minutes FROM features")),
    "implied_speed": (implied_speed, using("trips", f"""
        SELECT row_ord, {SPEED} AS implied_speed_kmh, coalesce({SPEED} <= 120, false) AS plausible_speed
        FROM trips""")),
}
