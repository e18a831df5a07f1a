"""Row features on edge values, against numpy formulas."""

from __future__ import annotations

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripkit.operators import enrich
from tripkit.operators.prep import feature_columns
from tripkit.plans.features import add_location_features, add_time_features, add_weather_features, build_features, encode_store_flag
from tripkit.plans.first_generation import coarse_features, with_speed
from tripkit.schema import FEATURE_ORDER, NON_FEATURES, ROW_ORDER
from tripkit.sources import derived


def times(spark, *values):
    rows = [(i, v) for i, v in enumerate(values)]
    return add_time_features(spark.createDataFrame(rows, "i int, pickup_datetime timestamp_ntz")).orderBy("i").collect()


def test_rush_hour_and_weekend(spark):
    rows = times(
        spark, datetime(2016, 6, 3, 19, 59), datetime(2016, 6, 4, 8, 0), datetime(2016, 6, 3, 9, 59),
        datetime(2016, 6, 3, 10, 0), datetime(2016, 6, 5, 23, 0),
    )
    assert [r["is_rush_hour"] for r in rows] == [1, 0, 1, 0, 0]
    assert [r["is_weekend"] for r in rows] == [0, 1, 0, 0, 1]
    assert [r["day_of_week"] for r in rows] == [4, 5, 4, 4, 6]
    assert [r["part_of_day"] for r in rows] == ["evening", "morning", "morning", "morning", "night"]


def test_hours_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert times(spark, datetime(2016, 3, 13, 2, 30))[0]["hour_of_day"] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_cycles(spark):
    row = times(spark, datetime(2016, 1, 4, 6, 0))[0]
    assert (row["hour_sin"], row["hour_cos"]) == (1.0, 0.0)
    assert (row["dow_sin"], row["dow_cos"]) == (0.0, 1.0)
    assert (row["month_sin"], row["month_cos"]) == (0.0, 1.0)


def points(spark, *rows):
    return spark.createDataFrame(rows, "pickup_lat double, pickup_lon double, dropoff_lat double, dropoff_lon double")


def test_identical_points_and_truncated_cells(spark):
    same, below, above = add_location_features(points(
        spark, (40.7, -74.0, 40.7, -74.0), (40.5, -74.052, 40.7, -74.0), (40.5, -74.048, 40.7, -74.0)
    )).collect()
    assert (same["haversine_km"], same["bearing_deg"], same["log_haversine_km"]) == (0.0, 0.0, 0.0)
    assert below["pickup_grid_y"] == above["pickup_grid_y"] == 0
    assert below["pickup_grid_x"] == 0


def test_distance_and_bearing_match_numpy(spark):
    rng = np.random.default_rng(3)
    n = 200
    cells = np.column_stack([rng.uniform(40.5, 40.92, n), rng.uniform(-74.26, -73.68, n),
                             rng.uniform(40.5, 40.92, n), rng.uniform(-74.26, -73.68, n)])
    got = add_location_features(points(spark, *[tuple(map(float, r)) for r in cells])).toPandas()
    lat1, lon1, lat2, lon2 = (np.radians(got[c]) for c in ("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"))
    central = np.arccos(np.sin(lat1) * np.sin(lat2) + np.cos(lat1) * np.cos(lat2) * np.cos(lon2 - lon1))
    np.testing.assert_allclose(got["haversine_km"], 6371 * central, atol=1e-3)
    east = np.sin(lon2 - lon1) * np.cos(lat2)
    north = np.cos(lat1) * np.sin(lat2) - np.sin(lat1) * np.cos(lat2) * np.cos(lon2 - lon1)
    np.testing.assert_allclose(got["bearing_deg"], np.degrees(np.arctan2(east, north)) % 360, atol=6e-3)


def test_null_coordinates_stay_null(spark):
    row = add_location_features(points(spark, (None, -74.0, 40.7, -74.0))).first()
    assert row["haversine_km"] is None and row["bearing_deg"] is None and row["pickup_grid_x"] is None


def test_store_flag(spark):
    df = spark.createDataFrame([(0, " y "), (1, "n"), (2, None), (3, "x"), (4, "Y")], "i int, store_and_fwd_flag string")
    rows = encode_store_flag(df).orderBy("i").collect()
    assert [r["store_and_fwd_flag"] for r in rows] == [1, 0, 0, 0, 1]


def test_weather_flags_use_full_precision(spark):
    df = spark.createDataFrame(
        [(0, 0.1, 0.0), (1, 0.11, 0.0), (2, 0.5, 1.0), (3, None, None)], "i int, precipitation double, snow_depth double")
    rows = add_weather_features(df).orderBy("i").collect()
    assert [r["is_raining"] for r in rows] == [0, 1, 0, 0]
    assert [r["is_snowing"] for r in rows] == [0, 0, 1, 0]
    assert [r["avg_temp_f"] for r in rows] == [0.0] * 4
    assert dict(add_weather_features(df).dtypes)["precipitation"] == "float"


def test_temperature_bands(spark):
    from tripkit.functions.weather import temperature_band

    df = spark.createDataFrame([(t,) for t in (0.0, 0.1, 32.0, 32.1, 80.0, 120.0, 120.5, None)], "t double")
    bands = [r[0] for r in df.select(temperature_band(F.col("t"))).collect()]
    assert bands == [None, "Freezing (<32F)", "Freezing (<32F)", "Cold (32-50F)", "Warm (65-80F)", "Hot (>80F)", None, None]


def test_feature_order(spark, sf_dir):
    trips = derived.trips(spark, sf_dir)
    table = build_features(enrich.without_weather(trips))
    numeric, text = feature_columns(table, [*NON_FEATURES, ROW_ORDER])
    assert numeric == FEATURE_ORDER and text == []


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="pickup_lat"):
        build_features(times_frame(spark))


def times_frame(spark):
    return spark.createDataFrame([(datetime(2016, 1, 1),)], "pickup_datetime timestamp_ntz")


def test_weather_join(spark):
    weather = spark.createDataFrame(
        [(0, date(2016, 1, 1), 30.0, 0.2), (1, date(2016, 1, 1), 99.0, 9.9), (2, date(2016, 1, 2), 40.0, None),
         (3, None, 1.0, 1.0)], "row_ord bigint, date date, avg_temp_f double, precipitation double")
    daily = enrich.daily_weather(weather)
    assert sorted((r["date"].day, r["avg_temp_f"]) for r in daily.collect()) == [(1, 30.0), (2, 40.0)]
    trips = spark.createDataFrame(
        [(1, datetime(2016, 1, 1, 23)), (2, datetime(2016, 1, 2)), (3, datetime(2016, 1, 9)), (4, None)],
        "i int, pickup_datetime timestamp_ntz")
    rows = enrich.enrich(trips, daily).orderBy("i").collect()
    assert [(r["avg_temp_f"], r["precipitation"]) for r in rows] == [(30.0, 0.2), (40.0, 0.0), (35.0, 0.0), (35.0, 0.0)]
    assert enrich.coverage(enrich.join_weather(trips, daily)).first()["n_matched"] == 2


def test_empty_weather_table(spark):
    from tripkit.schema import WEATHER_SCHEMA

    trips = spark.createDataFrame([(1, datetime(2016, 1, 1))], "i int, pickup_datetime timestamp_ntz")
    row = enrich.enrich(trips, spark.createDataFrame([], WEATHER_SCHEMA)).first()
    assert (row["avg_temp_f"], row["precipitation"], row["snow_depth"]) == (0.0, 0.0, 0.0)


def test_implied_speed_of_a_zero_duration(spark):
    df = points(spark, (40.7, -74.0, 40.8, -74.0)).withColumns({
        "trip_duration_sec": F.lit(0), "pickup_datetime": F.lit("2016-01-01").cast("timestamp_ntz")})
    row = with_speed(coarse_features(df)).first()
    assert row["implied_speed_kmh"] is None and row["plausible_speed"] is False
