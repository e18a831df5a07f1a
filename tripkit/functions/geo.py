"""Distance, direction and grid cells of a trip, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripkit.functions.numbers import rounded

# Earth radius, grid origin and grid cell size in degrees.
EARTH_RADIUS_KM = 6371.0
GRID_ORIGIN_LAT = 40.50
GRID_ORIGIN_LON = -74.05
GRID_CELL_DEG = 0.005


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance, unrounded; null when a coordinate is null."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    bounded = F.when(chord < 0.0, 0.0).when(chord > 1.0, 1.0).otherwise(chord)
    return F.asin(F.sqrt(bounded)) * F.lit(2 * EARTH_RADIUS_KM)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return rounded(great_circle_km(lat1, lon1, lat2, lon2), 4)


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Forward azimuth in degrees, 2 decimals; 0 for identical points."""
    from_lat, to_lat = F.radians(lat1), F.radians(lat2)
    turn = F.radians(lon2 - lon1)
    east = F.sin(turn) * F.cos(to_lat)
    north = F.cos(from_lat) * F.sin(to_lat) - F.sin(from_lat) * F.cos(to_lat) * F.cos(turn)
    return rounded((F.degrees(F.atan2(east, north)) + 360.0) % 360.0, 2)


def grid_index(value: Column, origin: float) -> Column:
    """Grid cell number, truncated toward zero (so cell 0 is two cells wide)."""
    return ((value - F.lit(origin)) / F.lit(GRID_CELL_DEG)).try_cast("int")


def distance_features(
    pickup_lat: Column, pickup_lon: Column, dropoff_lat: Column, dropoff_lon: Column
) -> dict[str, Column]:
    points = (pickup_lat, pickup_lon, dropoff_lat, dropoff_lon)
    return {"haversine_km": haversine_km(*points), "bearing_deg": bearing_deg(*points)}


def location_features(
    pickup_lat: Column, pickup_lon: Column, dropoff_lat: Column, dropoff_lon: Column,
    distance: Column, bearing: Column,
) -> dict[str, Column]:
    """What follows from the points and from their rounded distance and bearing."""
    return {
        "bearing_sin": rounded(F.sin(F.radians(bearing)), 6),
        "bearing_cos": rounded(F.cos(F.radians(bearing)), 6),
        "pickup_grid_x": grid_index(pickup_lat, GRID_ORIGIN_LAT),
        "pickup_grid_y": grid_index(pickup_lon, GRID_ORIGIN_LON),
        "dropoff_grid_x": grid_index(dropoff_lat, GRID_ORIGIN_LAT),
        "dropoff_grid_y": grid_index(dropoff_lon, GRID_ORIGIN_LON),
        "delta_lat": rounded(dropoff_lat - pickup_lat, 6),
        "delta_lon": rounded(dropoff_lon - pickup_lon, 6),
        "log_haversine_km": rounded(F.log1p(distance), 6),
    }


def implied_speed_kmh(distance_km: Column, minutes: Column) -> Column:
    """Average speed a trip needs; null when the duration is zero."""
    return F.try_divide(distance_km, minutes / 60.0)


def hex_cell(x: Column, y: Column, x_range: tuple[float, float], y_range: tuple[float, float],
             columns: int) -> tuple[Column, Column, Column]:
    """Hexagonal cell of a point: (lattice, column, row).

    A hexagonal tiling is two rectangular lattices shifted by half a cell; a point
    belongs to the nearer centre of the two candidates. ``columns`` cells span the x
    range and ``int(columns / sqrt(3))`` span the y range.
    """
    rows = int(columns / 3 ** 0.5)
    sx = (x - F.lit(x_range[0])) / F.lit((x_range[1] - x_range[0]) / columns)
    sy = (y - F.lit(y_range[0])) / F.lit((y_range[1] - y_range[0]) / rows)
    col0, row0 = F.floor(sx + 0.5), F.floor(sy + 0.5)
    col1, row1 = F.floor(sx), F.floor(sy)
    dist0 = (sx - col0) * (sx - col0) + (sy - row0) * (sy - row0) * 3.0
    dist1 = (sx - col1 - 0.5) * (sx - col1 - 0.5) + (sy - row1 - 0.5) * (sy - row1 - 0.5) * 3.0
    first = dist0 < dist1
    return (
        F.when(first, 0).otherwise(1),
        F.when(first, col0).otherwise(col1),
        F.when(first, row0).otherwise(row1),
    )
