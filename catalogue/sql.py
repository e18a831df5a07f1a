"""SQL building blocks (DuckDB spelling) shared by the oracle statements."""

from __future__ import annotations

import re

TRIPS = """
trips_raw AS (
  SELECT o_orderkey AS k,
         o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS pickup_datetime,
         CAST(floor(o_totalprice / cast(100 as double)) AS BIGINT) AS base_sec
  FROM orders
),
trips AS (
  SELECT k AS row_ord,
         'id' || CAST(CASE WHEN k % 97 = 0 AND k > 0 THEN k - 1 ELSE k END AS VARCHAR) AS trip_id,
         CAST(1 + k % 2 AS INTEGER) AS vendor_id,
         pickup_datetime,
         CASE WHEN k % 151 = 0 THEN NULL
              WHEN k % 149 = 0 THEN pickup_datetime - to_seconds(60)
              ELSE pickup_datetime + to_seconds(base_sec) END AS dropoff_datetime,
         CAST(k % 8 AS INTEGER) AS passenger_count,
         cast(-74.30 as double) + (k * 104729 % 6600) / cast(10000 as double) AS pickup_lon,
         CASE WHEN k % 131 <> 0 THEN cast(40.45 as double) + (k * 7919 % 4900) / cast(10000 as double) END AS pickup_lat,
         cast(-74.30 as double) + (k * 32452843 % 6600) / cast(10000 as double) AS dropoff_lon,
         cast(40.45 as double) + (k * 15485863 % 4900) / cast(10000 as double) AS dropoff_lat,
         CASE k % 5 WHEN 0 THEN 'N' WHEN 1 THEN 'Y' WHEN 2 THEN ' y ' WHEN 3 THEN 'n' END AS store_and_fwd_flag,
         base_sec * CASE WHEN k % 211 = 0 THEN 3 ELSE 1 END AS trip_duration_sec,
         round(base_sec * CASE WHEN k % 211 = 0 THEN 3 ELSE 1 END / cast(60 as double), 4) AS eta_minutes
  FROM trips_raw
)"""

WEATHER = """
weather AS (
  SELECT date,
         cast(15 as double) + d * 7 % 80 AS avg_temp_f,
         (d * 13 % 10) / cast(20 as double) AS precipitation,
         CASE WHEN d % 9 = 0 THEN cast(d % 4 as double) ELSE cast(0 as double) END AS snow_depth
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
               CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS d
        FROM orders)
  WHERE d % 11 <> 0
)"""


def box(lat: tuple[float, float], lon: tuple[float, float]) -> str:
    parts = [
        f"{side}_lat BETWEEN {lat[0]} AND {lat[1]} AND {side}_lon BETWEEN {lon[0]} AND {lon[1]}"
        for side in ("pickup", "dropoff")
    ]
    return " AND ".join(parts)


FLAGGED = f"""
flagged AS (
  SELECT *,
    (pickup_lat IS NULL OR pickup_lon IS NULL OR dropoff_lat IS NULL OR dropoff_lon IS NULL) AS missing_gps,
    (pickup_datetime IS NULL OR dropoff_datetime IS NULL
       OR coalesce(dropoff_datetime <= pickup_datetime, false)) AS invalid_timestamp,
    NOT coalesce({box((40.50, 40.92), (-74.26, -73.68))}, false) AS out_of_range,
    (eta_minutes IS NULL OR eta_minutes <= 0 OR eta_minutes > 120) AS invalid_eta,
    (passenger_count IS NULL OR passenger_count <= 0) AS invalid_passengers,
    row_number() OVER (PARTITION BY trip_id ORDER BY row_ord) > 1 AS duplicate_trip_id
  FROM trips
),
clean AS (
  SELECT * EXCLUDE (missing_gps, invalid_timestamp, out_of_range, invalid_eta, invalid_passengers, duplicate_trip_id)
  FROM flagged
  WHERE NOT (missing_gps OR invalid_timestamp OR out_of_range OR invalid_eta OR invalid_passengers OR duplicate_trip_id)
)"""

ENRICHED = """
enriched AS (
  SELECT t.*,
         coalesce(w.avg_temp_f, (SELECT median(avg_temp_f) FROM weather)) AS avg_temp_f,
         coalesce(w.precipitation, 0) AS precipitation,
         coalesce(w.snow_depth, 0) AS snow_depth
  FROM clean t LEFT JOIN weather w ON w.date = CAST(t.pickup_datetime AS DATE)
)"""

HALF_CHORD = (
    "pow(sin(radians(dropoff_lat - pickup_lat) / 2), 2) + cos(radians(pickup_lat)) * cos(radians(dropoff_lat))"
    " * pow(sin(radians(dropoff_lon - pickup_lon) / 2), 2)"
)
DISTANCE = f"round(cast(2 * 6371 as double) * asin(sqrt(CASE WHEN {HALF_CHORD} > 1 THEN 1 WHEN {HALF_CHORD} < 0 THEN 0 ELSE {HALF_CHORD} END)), 4)"
BEARING = (
    "round((degrees(atan2(sin(radians(dropoff_lon - pickup_lon)) * cos(radians(dropoff_lat)),"
    " cos(radians(pickup_lat)) * sin(radians(dropoff_lat))"
    " - sin(radians(pickup_lat)) * cos(radians(dropoff_lat)) * cos(radians(dropoff_lon - pickup_lon)))) + 360) % 360, 2)"
)
HOUR = "CAST(hour(pickup_datetime) AS INTEGER)"
DOW = "CAST(isodow(pickup_datetime) - 1 AS INTEGER)"
MONTH = "CAST(month(pickup_datetime) AS INTEGER)"
WEEKEND = f"CAST({DOW} >= 5 AS INTEGER)"
RUSH = f"CAST({DOW} < 5 AND ({HOUR} BETWEEN 7 AND 9 OR {HOUR} BETWEEN 16 AND 19) AS INTEGER)"
PART_OF_DAY = (
    f"CASE WHEN {HOUR} BETWEEN 5 AND 11 THEN 'morning' WHEN {HOUR} BETWEEN 12 AND 16 THEN 'afternoon'"
    f" WHEN {HOUR} BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END"
)
STORE_FLAG = "CAST(coalesce(upper(trim(store_and_fwd_flag)) = 'Y', false) AS INTEGER)"


def cyclic(name: str, value: str, period: int) -> str:
    angle = f"2 * pi() * ({value}) / {period}"
    return f"round(sin({angle}), 6) AS {name}_sin, round(cos({angle}), 6) AS {name}_cos"


def grid(value: str, origin: float) -> str:
    return f"CAST(trunc(({value} - cast({origin} as double)) / cast(0.005 as double)) AS INTEGER)"


TIME_COLUMNS = (
    f"{HOUR} AS hour_of_day, {DOW} AS day_of_week, {MONTH} AS month, {WEEKEND} AS is_weekend,"
    f" {RUSH} AS is_rush_hour, {PART_OF_DAY} AS part_of_day"
)
CYCLE_COLUMNS = ", ".join([cyclic("hour", HOUR, 24), cyclic("dow", DOW, 7), cyclic("month", f"{MONTH} - 1", 12)])
GEO_COLUMNS = (
    f"{DISTANCE} AS haversine_km, {BEARING} AS bearing_deg,"
    f" round(sin(radians({BEARING})), 6) AS bearing_sin, round(cos(radians({BEARING})), 6) AS bearing_cos,"
    " round(dropoff_lat - pickup_lat, 6) AS delta_lat, round(dropoff_lon - pickup_lon, 6) AS delta_lon,"
    f" round(ln(1 + {DISTANCE}), 6) AS log_haversine_km"
)
GRID_COLUMNS = (
    f"{grid('pickup_lat', 40.50)} AS pickup_grid_x, {grid('pickup_lon', -74.05)} AS pickup_grid_y,"
    f" {grid('dropoff_lat', 40.50)} AS dropoff_grid_x, {grid('dropoff_lon', -74.05)} AS dropoff_grid_y"
)
WEATHER_COLUMNS = (
    "CAST(coalesce(snow_depth > 0, false) AS INTEGER) AS is_snowing,"
    " CAST(coalesce(precipitation > 0.1, false) AND NOT coalesce(snow_depth > 0, false) AS INTEGER) AS is_raining"
)

FEATURES = f"""
features AS (
  SELECT row_ord, trip_id, pickup_datetime, eta_minutes, vendor_id, passenger_count,
         pickup_lon, pickup_lat, dropoff_lon, dropoff_lat,
         {STORE_FLAG} AS store_and_fwd_flag,
         CAST(avg_temp_f AS FLOAT) AS avg_temp_f, CAST(precipitation AS FLOAT) AS precipitation,
         CAST(snow_depth AS FLOAT) AS snow_depth,
         {TIME_COLUMNS}, {CYCLE_COLUMNS}, {GEO_COLUMNS}, {GRID_COLUMNS}, {WEATHER_COLUMNS}
  FROM enriched
)"""


def row_hash(key: str, seed: int = 42) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 13) AS BIGINT)"


def split_of(key: str = "trip_id", test: float = 0.2, val: float = 0.1, seed: int = 42) -> str:
    u = f"({row_hash(key, seed)} / cast(4503599627370496 as double))"
    return f"CASE WHEN {u} < {test} THEN 'test' WHEN {u} < {test + val} THEN 'val' ELSE 'train' END"


PARTS = {"trips": TRIPS, "weather": WEATHER, "flagged": FLAGGED, "enriched": ENRICHED, "features": FEATURES}
NEEDS = {
    "trips": [], "weather": [], "flagged": ["trips"], "enriched": ["flagged", "weather"],
    "features": ["enriched"],
}


def using(part: str, body: str, *more: str) -> str:
    """Statement ``body`` with the named building blocks in front of it."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS[name]:
            add(need)
        if name not in order:
            order.append(name)

    for name in (part, *more):
        add(name)
    blocks = ",".join(PARTS[name] for name in order)
    body = body.strip()
    if re.match(r"(?i)with\s", body):
        return f"WITH {blocks},{body[4:]}"
    return f"WITH {blocks}\n{body}"
