"""Column names, types, name maps and validation profiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Published input format, feature order and thresholds.
# ---------------------------------------------------------------------------
TRIP_RENAMES = {
    "id": "trip_id",
    "pickup_longitude": "pickup_lon",
    "pickup_latitude": "pickup_lat",
    "dropoff_longitude": "dropoff_lon",
    "dropoff_latitude": "dropoff_lat",
    "trip_duration": "trip_duration_sec",
}

WEATHER_RENAMES = {
    "maximum temperature": "max_temp_f",
    "minimum temperature": "min_temp_f",
    "average temperature": "avg_temp_f",
    "snow fall": "snow_fall",
    "snow depth": "snow_depth",
}

REQUIRED_COLUMNS = [
    "trip_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "pickup_lon", "pickup_lat", "dropoff_lat", "dropoff_lon", "vendor_id", "eta_minutes",
]

COORDINATES = ["pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"]
TARGET = "eta_minutes"
NON_FEATURES = [
    "eta_minutes", "trip_id", "pickup_datetime", "dropoff_datetime",
    "trip_duration_sec", "part_of_day",
]

FEATURE_ORDER = [
    "vendor_id", "passenger_count", "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat",
    "store_and_fwd_flag", "avg_temp_f", "precipitation", "snow_depth",
    "hour_of_day", "day_of_week", "month", "is_weekend", "is_rush_hour",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "haversine_km", "bearing_deg", "bearing_sin", "bearing_cos",
    "pickup_grid_x", "pickup_grid_y", "dropoff_grid_x", "dropoff_grid_y",
    "delta_lat", "delta_lon", "log_haversine_km", "is_snowing", "is_raining",
]

# Numeric columns the exploratory statistics look at, in report order.
PROFILE_NUMERICS = [
    "passenger_count", "hour_of_day", "day_of_week", "month", "is_weekend", "is_rush_hour",
    "haversine_km", "bearing_deg", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon",
    "delta_lat", "delta_lon", "log_haversine_km",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "bearing_sin", "bearing_cos",
    "avg_temp_f", "precipitation", "snow_depth", "is_snowing", "is_raining",
]
PROFILE_CATEGORICALS = ["vendor_id", "store_and_fwd_flag"]

SEED = 42
TEST_SIZE = 0.20
VAL_SIZE = 0.10
MIN_PASS_RATE = 0.80
WEATHER_COLUMNS = ["avg_temp_f", "precipitation", "snow_depth", "snow_fall"]
# ---------------------------------------------------------------------------

ROW_ORDER = "row_ord"

WEATHER_SCHEMA = T.StructType(
    [T.StructField("date", T.DateType())]
    + [
        T.StructField(c, T.DoubleType())
        for c in ("max_temp_f", "min_temp_f", "avg_temp_f", "precipitation", "snow_fall", "snow_depth")
    ]
)

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_ord", T.LongType()),
    T.StructField("pickup_datetime", T.StringType()),
    T.StructField("pickup_lat", T.DoubleType()),
    T.StructField("pickup_lon", T.DoubleType()),
    T.StructField("dropoff_lat", T.DoubleType()),
    T.StructField("dropoff_lon", T.DoubleType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("vendor_id", T.IntegerType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("dropoff_datetime", T.StringType()),
    T.StructField("avg_temp_f", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
    T.StructField("snow_depth", T.DoubleType()),
])


@dataclass(frozen=True)
class Thresholds:
    """Limits of the row rules; ``None`` switches a limit off."""

    lat: tuple[float, float]
    lon: tuple[float, float]
    min_eta: float | None = None
    max_eta: float | None = None
    min_duration_sec: int | None = None
    max_duration_sec: int | None = None
    max_passengers: int | None = None


# The three published threshold sets.
#   ENFORCED   what rows are really held to (no passenger cap, no minimum duration)
#   DOCUMENTED the same with the limits the documentation names
#   ROUGH      the wider first-generation box with a duration window in seconds
ENFORCED = Thresholds(lat=(40.50, 40.92), lon=(-74.26, -73.68), max_eta=120.0)
DOCUMENTED = Thresholds(
    lat=(40.50, 40.92), lon=(-74.26, -73.68), min_eta=1.0, max_eta=120.0, max_passengers=6
)
ROUGH = Thresholds(
    lat=(40.4, 41.0), lon=(-74.3, -73.6),
    min_duration_sec=30, max_duration_sec=21600, max_passengers=6,
)
