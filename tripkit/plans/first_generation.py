"""The earlier job: wide validation, time split, coarse features, train-fitted bins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.functions import geo, time
from tripkit.operators import prep, quality, splitting
from tripkit.operators.lookup import lookup_join
from tripkit.plans.profile import profile
from tripkit.schema import COORDINATES, ROUGH, ROW_ORDER
from tripkit.session import materialize
from tripkit.sources.versions import write_snapshot

# Fixed value: bins per coordinate axis.
LOCATION_BINS = 10


def coarse_features(df: DataFrame) -> DataFrame:
    """Calendar columns and great-circle distance under the earlier names."""
    ts = F.col("pickup_datetime")
    return df.withColumns({
        "trip_date": F.to_date(ts),
        "hour_of_day": time.hour_of_day(ts),
        "day_of_week": time.day_of_week(ts),
        "is_weekend": time.is_weekend(ts),
        "month": F.month(ts),
        "is_rush_hour": time.is_rush_hour(ts),
        "trip_distance_km": geo.haversine_km(*[F.col(c) for c in COORDINATES]),
    })


def attach_weather(df: DataFrame, weather: DataFrame, at: str = "trip_date") -> DataFrame:
    """Carry every column of a daily table (temp_c, precip_mm, weather_condition) by date."""
    return lookup_join(df, weather.withColumnRenamed("date", at), [at])


def with_speed(df: DataFrame, limit_kmh: float = 120.0) -> DataFrame:
    """Implied speed and whether it is plausible."""
    speed = geo.implied_speed_kmh(F.col("trip_distance_km"), F.col("trip_duration_sec") / 60.0)
    return df.withColumn("implied_speed_kmh", speed).withColumn(
        "plausible_speed", F.coalesce(F.col("implied_speed_kmh") <= limit_kmh, F.lit(False))
    )


def split_and_bin(
    clean: DataFrame, weather: DataFrame | None = None, test_size: float = 0.2
) -> tuple[DataFrame, dict[str, list[float]]]:
    """Time split, coarse features, and location bins whose edges come from train only."""
    split = coarse_features(splitting.time_split(clean, test_size=test_size))
    if weather is not None:
        split = attach_weather(split, weather)
    split = materialize(split)
    edges = prep.fit_bins(split.where(F.col("split") == "train"), COORDINATES, LOCATION_BINS)
    return prep.apply_bins(split, edges), edges


def run(trips: DataFrame, base: str, source: str, weather: DataFrame | None = None) -> dict:
    """Validate, split by time, build features and write one snapshot per split."""
    clean = quality.rough_clean_rows(trips, ROUGH)
    report = quality.rough_report(trips, ROUGH).first().asDict()
    table, edges = split_and_bin(clean, weather)
    ids = {}
    for name in ("train", "test"):
        part = table.where(F.col("split") == name).drop("split", ROW_ORDER)
        ids[name] = write_snapshot(part, base, f"{source}_{name}_split", report)
    train = trips.sparkSession.read.parquet(f"{base}/{ids['train']}.parquet")
    tables, failures = profile(train)
    return {"report": report, "snapshots": ids, "edges": edges, "profile": tables, "failures": failures}
