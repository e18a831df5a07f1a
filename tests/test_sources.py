"""CSV readers, run metrics and stage events."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from tripkit.sources import readers, tracking

TRIPS = """id,vendor_id,pickup_datetime,dropoff_datetime,passenger_count,pickup_longitude,pickup_latitude,dropoff_longitude,dropoff_latitude,store_and_fwd_flag,trip_duration
a,2,2016-03-14 17:24:55,2016-03-14 17:32:30,1,-73.98,40.76,-73.96,40.77,N,455
b,x,not a time,2016-03-14 17:32:30,2.0,oops,40.76,-73.96,NaN,Y,100
c,1,2016-02-30 10:00:00,,2.7,-73.98,,-73.96,40.77,,abc
"""
WEATHER = """Date, Maximum Temperature ,minimum temperature,average temperature,precipitation,snow fall,snow depth
1-1-2016,42,34,38.0,0.00,0.0,0
01-02-2016,50,30,40.0,T,0.1,2
1-1-2016,99,99,99.0,9,9,9
32-1-2016,1,1,1,1,1,1
,1,1,1,1,1,1
"""


def test_trips(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text(TRIPS)
    df = readers.read_trips(spark, str(tmp_path / "absent.csv"), str(path))
    assert dict(df.dtypes)["pickup_datetime"] == "timestamp_ntz" and dict(df.dtypes)["passenger_count"] == "int"
    a, b, c = df.orderBy("row_ord").collect()
    assert a["trip_id"] == "a" and a["eta_minutes"] == 7.5833 and a["pickup_datetime"] == datetime(2016, 3, 14, 17, 24, 55)
    assert a["trip_duration_sec"] == 455 and a["pickup_lon"] == -73.98
    assert (b["vendor_id"], b["pickup_datetime"], b["passenger_count"]) == (None, None, 2)
    assert (b["pickup_lon"], b["dropoff_lat"]) == (None, None)
    assert (c["pickup_datetime"], c["passenger_count"], c["eta_minutes"]) == (None, None, None)


def test_absent_columns_are_skipped(spark, tmp_path):
    path = tmp_path / "few.csv"
    path.write_text("id,eta_minutes\nq,12.5\n")
    row = readers.read_trips(spark, str(path)).first()
    assert row["trip_id"] == "q" and row["eta_minutes"] == 12.5


def test_missing_trips_are_an_error_and_missing_weather_is_not(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_trips(spark, str(tmp_path / "none.csv"))
    empty = readers.read_weather(spark, str(tmp_path / "none.csv"))
    assert empty.count() == 0 and "avg_temp_f" in empty.columns
    assert readers.read_weather(spark, None).count() == 0


def test_weather(spark, tmp_path):
    path = tmp_path / "weather.csv"
    path.write_text(WEATHER)
    rows = readers.read_weather(spark, str(path)).orderBy("date").collect()
    assert [(r["date"], r["avg_temp_f"], r["max_temp_f"], r["precipitation"]) for r in rows] == [
        (date(2016, 1, 1), 38.0, 42.0, 0.0), (date(2016, 2, 1), 40.0, 50.0, None)]


def test_row_order_follows_the_file(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("id,eta_minutes\n" + "".join(f"{i},{i}\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        df = readers.read_trips(spark, str(path))
        assert df.rdd.getNumPartitions() > 4
        assert [int(r["trip_id"]) for r in df.orderBy("row_ord").select("trip_id").collect()] == list(range(20000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_head_csv(spark, tmp_path):
    df = spark.range(100).selectExpr("id AS row_ord", "id * 2 AS x").repartition(5)
    readers.write_head_csv(df, str(tmp_path / "head"), 3)
    rows = readers.read_text_csv(spark, str(tmp_path / "head")).collect()
    assert sorted(int(r["x"]) for r in rows) == [0, 2, 4]


def test_run_metrics(spark, tmp_path):
    base = str(tmp_path)
    tracking.log_metrics(spark, base, "r1", "eda", {"skew": 1.5, "none": None})
    tracking.log_metrics(spark, base, "r2", "eda", {"skew": 2.5}, parent="r1")
    rows = {(r["run_id"], r["key"]): r["value"] for r in tracking.read_metrics(spark, base).collect()}
    assert rows == {("r1", "skew"): "1.5", ("r1", "none"): None, ("r2", "skew"): "2.5"}


def test_promotion_archives_the_previous_version(spark, tmp_path):
    base = str(tmp_path)
    assert tracking.read_stages(spark, base).count() == 0
    for version in (1, 2, 3):
        events = tracking.read_stages(spark, base)
        assert tracking.next_model_version(events, "m") == version
        tracking.append_stages(tracking.promotion_events(events, "m", version, f"v{version}"), base)
    stages = {r["version"]: r["stage"] for r in tracking.current_stages(tracking.read_stages(spark, base)).collect()}
    assert stages == {1: "Archived", 2: "Archived", 3: "Production"}
    row = tracking.production_version(tracking.read_stages(spark, base)).first()
    assert (row["version"], row["dataset_version"]) == (3, "v3")


def test_rows_are_numbered_by_file_whatever_their_size(spark, tmp_path):
    for name, rows in (("part-0.csv", 1), ("part-1.csv", 2001), ("part-2.csv", 3)):
        (tmp_path / name).write_text("v\n" + "".join(f"{name}:{k}\n" for k in range(rows)))
    numbered = readers.with_row_order(readers.read_text_csv(spark, str(tmp_path))).orderBy(readers.ROW_ORDER).collect()
    assert [r[readers.ROW_ORDER] for r in numbered] == list(range(2005))
    assert [r["v"] for r in numbered][:2] == ["part-0.csv:0", "part-1.csv:0"] and numbered[-1]["v"] == "part-2.csv:2"


def test_colliding_cells_hash_apart(spark):
    from tripkit.operators.content import hash_text

    pairs = [([("a|b", "c")], [("a", "b|c")]), ([("~", "x")], [(None, "x")]), ([("-", "x")], [(None, "x")]), ([("1:a", "")], [("1", ":a")])]
    for left, right in pairs:
        one, two = (hash_text(spark.createDataFrame(rows, "a string, b string")) for rows in (left, right))
        assert one != two
    near = [spark.createDataFrame([(v,)], "x double") for v in (1e-9, 4e-7, 0.1, 0.30000000000000004, 0.3)]
    assert len({hash_text(df) for df in near}) == 5
    wide = [spark.sql(f"SELECT CAST('{v}' AS DECIMAL(38, 2)) AS x") for v in ("123456789012345678901.13", "123456789012345678902.00")]
    assert hash_text(wide[0]) != hash_text(wide[1])


def test_one_failing_table_does_not_stop_the_profile(spark, tmp_path):
    from pyspark.sql import functions as F

    from tripkit.plans.profile import write_profile

    tables = {"good": spark.range(3), "bad": spark.range(3).select(F.raise_error(F.lit("broken part")).alias("x")), "later": spark.range(2)}
    failures = write_profile(tables, str(tmp_path / "profile"))
    assert list(failures) == ["bad"] and "broken part" in failures["bad"]
    assert spark.read.json(str(tmp_path / "profile/later")).count() == 2
