"""Streams give what the batch gives."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tripkit.operators import monitoring, quality
from tripkit.sources import derived
from tripkit.streaming import jobs


def trips(spark, sf_dir):
    return derived.trips_of_orders(jobs.read_table_stream(spark, sf_dir, "orders.parquet"))


def test_route_equals_batch(spark, sf_dir, tmp_path):
    jobs.route(trips(spark, sf_dir), str(tmp_path)).awaitTermination()
    written = spark.read.parquet(f"{tmp_path}/data")
    flagged = quality.with_outcome(
        derived.trips(spark, sf_dir).withColumn("reasons", quality.reasons_of(quality.row_rules())))
    pick = ["row_ord", "outcome", "reasons"]
    assert written.select(pick).exceptAll(flagged.select(pick)).isEmpty()
    assert written.count() == flagged.count()


def test_route_goes_on_where_it_stopped(spark, sf_dir, tmp_path):
    source = tmp_path / "in"
    spark.read.parquet(f"{sf_dir}/orders.parquet").limit(100).coalesce(1).write.parquet(str(source))
    for expected in (100, 150):
        stream = derived.trips_of_orders(spark.readStream.schema(
            spark.read.parquet(str(source)).schema).parquet(str(source)))
        jobs.route(stream, str(tmp_path / "out")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out" / "data")).count() == expected
        spark.read.parquet(f"{sf_dir}/orders.parquet").limit(50).coalesce(1).write.mode("append").parquet(str(source))


def test_deduplicate_a_hot_key(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(3000).select(
        F.col("id").alias("row_ord"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("trip_id"),
        F.lit(datetime(2016, 1, 1)).cast("timestamp_ntz").alias("at")).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    jobs.write_stream(jobs.deduplicate(stream, "trip_id", "at"), str(tmp_path / "out")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out" / "data"))
    assert out.count() == out.select("trip_id").distinct().count() == 2001


def test_monitor_equals_batch_for_closed_windows(spark, tmp_path):
    start = datetime(2016, 1, 1)
    rows = [(i, f"t{i}", start + timedelta(hours=i), float(i % 13), float(i % 7)) for i in range(240)]
    table = spark.createDataFrame(rows, "row_ord bigint, trip_id string, at timestamp_ntz, prediction double, label double")
    log, seen = table.select("trip_id", "at", "prediction"), table.select(
        "row_ord", "trip_id", F.timestamp_add("MINUTE", F.lit(20), F.col("at")).alias("actual_at"), "label")
    for name, df in (("log", log), ("seen", seen)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
    streams = [
        spark.readStream.schema(df.schema).parquet(str(tmp_path / name)) for name, df in (("log", log), ("seen", seen))
    ]
    jobs.write_stream(jobs.monitor(*streams, "trip_id", "at"), str(tmp_path / "out")).awaitTermination()
    got = {r["window_start"]: r for r in spark.read.parquet(str(tmp_path / "out" / "data")).collect()}
    joined = monitoring.join_actuals(log, table.select("row_ord", "trip_id", "label"))
    want = {r["window_start"]: r for r in monitoring.accuracy_by_window(joined, "at", "label", "prediction", digits=6).collect()}
    assert len(want) == 10 and 8 <= len(got) < 10
    for day, r in got.items():
        assert (r["n_rows"], r["rmse"], r["bias"]) == (24, want[day]["rmse"], want[day]["bias"])


def test_repeated_actuals_do_not_multiply_rows(spark):
    log = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "trip_id string, prediction double")
    actuals = spark.createDataFrame([(2, "a", 9.0), (1, "a", 5.0), (3, "c", 1.0)], "row_ord bigint, trip_id string, label double")
    rows = sorted(tuple(r) for r in monitoring.join_actuals(log, actuals).collect())
    assert rows == [("a", 1.0, 5.0), ("a", 2.0, 5.0)]
