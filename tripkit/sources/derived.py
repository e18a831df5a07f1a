"""Trips, weather, requests and actuals derived from the driver's order table.

The driver tables hold no coordinates, so trips are integer arithmetic on the order key,
which gives the same values in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.functions.numbers import rounded
from tripkit.functions.weather import holds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips_of_orders(orders: DataFrame) -> DataFrame:
    """Works on a batch or a stream of orders."""
    k = F.col("o_orderkey")

    def every(n: int):
        return holds(k % n == 0)

    def spread(factor: int, modulus: int, origin: float):
        return F.lit(origin) + (k * factor % modulus) / 10000.0

    base_sec = F.floor(F.col("o_totalprice") / 100.0).cast("bigint")
    start = F.timestamp_add("SECOND", (k * 7919 % 86400).cast("int"), F.col("o_orderdate"))
    end = F.timestamp_add(
        "SECOND", F.when(every(149), F.lit(-60)).otherwise(base_sec.cast("int")), F.col("__start")
    )
    trips = orders.withColumn("__start", start).select(
        k.alias("row_ord"),
        F.concat(F.lit("id"), F.when(every(97) & (k > 0), k - 1).otherwise(k).cast("string")).alias("trip_id"),
        (k % 2 + 1).cast("int").alias("vendor_id"),
        F.col("__start").alias("pickup_datetime"),
        F.when(~every(151), end).alias("dropoff_datetime"),
        (k % 8).cast("int").alias("passenger_count"),
        spread(104729, 6600, -74.30).alias("pickup_lon"),
        F.when(~every(131), spread(7919, 4900, 40.45)).alias("pickup_lat"),
        spread(32452843, 6600, -74.30).alias("dropoff_lon"),
        spread(15485863, 4900, 40.45).alias("dropoff_lat"),
        F.element_at(
            F.array(F.lit("N"), F.lit("Y"), F.lit(" y "), F.lit("n"), F.lit(None)), (k % 5 + 1).cast("int")
        ).alias("store_and_fwd_flag"),
        (base_sec * F.when(every(211), 3).otherwise(1)).alias("trip_duration_sec"),
    )
    return trips.withColumn("eta_minutes", rounded(F.col("trip_duration_sec") / 60, 4))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_of_orders(table(spark, sf_dir, "orders"))


def weather_of_orders(orders: DataFrame) -> DataFrame:
    day = F.datediff(F.col("date"), F.lit("1995-01-01").cast("date"))
    return (
        orders.select(F.to_date("o_orderdate").alias("date")).distinct()
        .withColumn("__d", day)
        .where(F.col("__d") % 11 != 0)
        .select(
            "date",
            (F.lit(15.0) + F.col("__d") * 7 % 80).alias("avg_temp_f"),
            ((F.col("__d") * 13 % 10) / 20.0).alias("precipitation"),
            F.when(F.col("__d") % 9 == 0, (F.col("__d") % 4).cast("double")).otherwise(0.0).alias("snow_depth"),
        )
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_of_orders(table(spark, sf_dir, "orders"))
