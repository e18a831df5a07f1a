"""Windows of a stream from partial sums equal those of the batch, the last ones too."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tripkit.operators import monitoring
from tripkit.streaming import partials

SCHEMA = "row_ord bigint, trip_id string, at timestamp_ntz, prediction double, label double, actual_at timestamp_ntz"


def rows_of(spark):
    """240 hours; predictions and labels that are null, actuals that come late, never or too early."""
    start = datetime(2016, 1, 1)
    rows = []
    for i in range(240):
        at = start + timedelta(hours=i)
        arrives = {0: None, 1: at - timedelta(minutes=1), 2: at + timedelta(days=2)}.get(i % 17, at + timedelta(minutes=20))
        rows.append((i, f"t{i}", at, None if i % 11 == 0 or i >= 216 else float(i % 13), None if i % 13 == 0 else float(i % 7), arrives))
    return spark.createDataFrame(rows, SCHEMA)


def sides(df):
    return df.select("trip_id", "at", "prediction"), df.select("row_ord", "trip_id", "actual_at", "label")


def batch(table):
    joined = table.where("actual_at >= at AND actual_at <= at + INTERVAL 1 DAY").withColumn("at", F.col("at").cast("timestamp"))
    return monitoring.accuracy_by_window(joined, "at", "label", "prediction", digits=6)


def by_window(df):
    return {r["window_start"]: tuple(r)[1:] for r in df.collect()}


def test_sums_of_a_batch(spark):
    table = rows_of(spark).where("at IS NOT NULL").withColumn("at", F.col("at").cast("timestamp"))
    sums = partials.window_sums(table.repartition(5), "at", "label", "prediction")
    want = by_window(monitoring.accuracy_by_window(table, "at", "label", "prediction", digits=6))
    assert by_window(partials.merged_windows(sums, 6)) == want
    assert by_window(partials.merged_windows(partials.window_sums(table.limit(0), "at", "label", "prediction"))) == {}
    unknown = table.withColumn("at", F.lit(None).cast("timestamp"))
    assert by_window(partials.merged_windows(partials.window_sums(unknown, "at", "label", "prediction"))) == {}


def test_stream_equals_batch_in_every_window(spark, tmp_path):
    """Two runs of the query over files that arrive in between; the second goes on from the first one's checkpoint."""
    table = rows_of(spark)
    folders = [str(tmp_path / n) for n in ("log", "seen")]
    for part in ("row_ord < 130", "row_ord >= 130"):
        for folder, side in zip(folders, sides(table.where(part)), strict=True):
            side.coalesce(1).write.mode("append").parquet(folder)
        streams = [spark.readStream.schema(side.schema).parquet(folder) for folder, side in zip(folders, sides(table), strict=True)]
        partials.monitor_windows(*streams, "trip_id", "at", str(tmp_path / "out")).awaitTermination()
    got, want = by_window(partials.read_windows(spark, str(tmp_path / "out"), 6)), by_window(batch(table))
    assert len(want) == 10 and got == want
    assert min(n for n, *_ in want.values()) == 0  # the last day has no known error, and is there
