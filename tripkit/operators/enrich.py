"""Daily weather: one row per date, join to trips, fill, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.operators.lookup import lookup_join
from tripkit.operators.selection import exact_medians
from tripkit.schema import ROW_ORDER, WEATHER_COLUMNS
from tripkit.session import materialize


def first_per_key(df: DataFrame, keys: list[str], order: str = ROW_ORDER) -> DataFrame:
    """The first row of each key in input order, as a map-side combined aggregate."""
    # one min_by per column keeps fixed-width columns in hash aggregation; ``order`` is unique
    firsts = [F.min_by(c, order).alias(c) for c in df.columns if c not in (*keys, order)]
    return df.groupBy(*keys).agg(F.min(order).alias(order), *firsts).select(*df.columns)


def daily_weather(df: DataFrame, order: str = ROW_ORDER) -> DataFrame:
    """Rows with a date, one per date, first in input order."""
    return first_per_key(df.na.drop(subset=["date"]), ["date"], order).drop(order)


def carried_columns(weather: DataFrame) -> list[str]:
    return [c for c in WEATHER_COLUMNS if c in weather.columns]


def join_weather(trips: DataFrame, weather: DataFrame, at: str = "pickup_datetime") -> DataFrame:
    """Left join on the pickup date; unmatched trips keep nulls and ``weather_matched`` false."""
    slim = weather.select(
        F.col("date").alias("__date"), *carried_columns(weather), F.lit(True).alias("__matched")
    )
    joined = lookup_join(trips.withColumn("__date", F.to_date(at)), slim, ["__date"])
    return joined.withColumn("weather_matched", F.coalesce("__matched", F.lit(False))).drop(
        "__date", "__matched"
    )


def weather_fill(weather: DataFrame) -> dict[str, float]:
    """Values for trips without weather: the table's median temperature, no rain, no snow."""
    fill = {c: 0.0 for c in carried_columns(weather)}
    if "avg_temp_f" in fill:
        median = exact_medians(weather, ["avg_temp_f"])["avg_temp_f"]
        fill["avg_temp_f"] = 0.0 if median is None else median
    return fill


def fill_weather(joined: DataFrame, fill: dict[str, float]) -> DataFrame:
    return joined.fillna(fill)


def without_weather(trips: DataFrame) -> DataFrame:
    """Constant weather columns for a run that has no weather table."""
    return trips.withColumns({c: F.lit(0.0) for c in ("avg_temp_f", "precipitation", "snow_depth")})


def enrich(trips: DataFrame, weather: DataFrame | None) -> DataFrame:
    """Join and fill weather; an absent or empty table gives constant columns.

    The table is read for the fill and for the join, so it is stored first.
    """
    if weather is None:
        return without_weather(trips)
    weather = materialize(weather)
    if weather.isEmpty():
        return without_weather(trips)
    return fill_weather(join_weather(trips, weather), weather_fill(weather)).drop("weather_matched")


def coverage(joined: DataFrame) -> DataFrame:
    """How many trips found weather, counted before any filling."""
    total = F.count(F.lit(1))
    matched = F.count_if("weather_matched")
    return joined.agg(
        total.alias("n_trips"), matched.alias("n_matched"),
        F.round(F.try_divide(matched, total), 6).alias("coverage"),
    )


def weather_span(weather: DataFrame) -> DataFrame:
    return weather.agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count("date").alias("n_days"),
    )


def dense(aggregated: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Rows for a fixed list of key values in its order; absent groups come out null."""
    spark = aggregated.sparkSession
    frame = spark.createDataFrame(list(enumerate(values)), f"ordinal int, {key} string")
    return frame.join(aggregated, key, "left").select("ordinal", *aggregated.columns)
