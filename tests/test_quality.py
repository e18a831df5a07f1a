"""Row rules on hand-made edge rows, and the split into clean and quarantine."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripkit.operators import quality
from tripkit.schema import DOCUMENTED, ENFORCED

START = datetime(2016, 3, 4, 10, 0, 0)
SCHEMA = (
    "row_ord bigint, trip_id string, vendor_id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz,"
    " passenger_count int, pickup_lat double, pickup_lon double, dropoff_lat double, dropoff_lon double,"
    " eta_minutes double, store_and_fwd_flag string"
)
GOOD = dict(
    trip_id=None, vendor_id=1, pickup_datetime=START, dropoff_datetime=START + timedelta(minutes=9),
    passenger_count=1, pickup_lat=40.7, pickup_lon=-73.9, dropoff_lat=40.8, dropoff_lon=-74.0, eta_minutes=9.0,
    store_and_fwd_flag="N",
)


def trips(spark, *changes):
    rows = []
    for i, change in enumerate(changes):
        row = {**GOOD, "trip_id": f"t{i}", **change}
        rows.append((i, *[row[c] for c in SCHEMA_NAMES[1:]]))
    return spark.createDataFrame(rows, SCHEMA)


SCHEMA_NAMES = [part.strip().split(" ")[0] for part in SCHEMA.split(",")]


def reasons(spark, *changes, limits=ENFORCED):
    flagged = quality.flag_rows(trips(spark, *changes), limits)
    return [r["reasons"] for r in flagged.orderBy("row_ord").collect()]


def test_edge_rows(spark):
    cases = [
        ({}, []),
        ({"pickup_lat": None}, ["missing_gps", "out_of_range"]),
        ({"pickup_lat": 40.50, "dropoff_lat": 40.92}, []),
        ({"pickup_lat": 40.4999}, ["out_of_range"]),
        ({"dropoff_lon": -73.68}, []),
        ({"dropoff_datetime": START}, ["invalid_timestamp"]),
        ({"pickup_datetime": None}, ["invalid_timestamp"]),
        ({"eta_minutes": 0.0167}, []),
        ({"eta_minutes": 120.0}, []),
        ({"eta_minutes": 120.0167}, ["invalid_eta"]),
        ({"eta_minutes": 0.0}, ["invalid_eta"]),
        ({"eta_minutes": None}, ["invalid_eta"]),
        ({"passenger_count": 0}, ["invalid_passengers"]),
        ({"passenger_count": None}, ["invalid_passengers"]),
        ({"passenger_count": 7}, []),
    ]
    assert reasons(spark, *[c for c, _ in cases]) == [r for _, r in cases]


def test_documented_limits_are_stricter(spark):
    got = reasons(spark, {"eta_minutes": 0.5}, {"passenger_count": 7}, {"eta_minutes": 1.0}, limits=DOCUMENTED)
    assert got == [["invalid_eta"], ["invalid_passengers"], []]


def test_duplicates_are_judged_before_any_filter(spark):
    got = reasons(spark, {"trip_id": "a", "eta_minutes": -1.0}, {"trip_id": "a"}, {"trip_id": "b"})
    assert got == [["invalid_eta"], ["duplicate_trip_id"], []]


def test_null_ids_equal_each_other(spark):
    assert reasons(spark, {"trip_id": None}, {"trip_id": None}, {"trip_id": None}) == [
        [], ["duplicate_trip_id"], ["duplicate_trip_id"]]


def test_without_an_id_column_nothing_is_a_duplicate(spark):
    flagged = quality.flag_rows(trips(spark, {}, {}).drop("trip_id"))
    assert quality.clean_rows(flagged).count() == 2


def test_one_id_holding_a_third_of_all_rows(spark):
    df = spark.range(9000).select(
        F.col("id").alias("row_ord"),
        F.when(F.col("id") % 3 == 1, "hot").when(F.col("id") % 3 == 2, F.lit(None)).otherwise(
            F.col("id").cast("string")).alias("trip_id"))
    kept = quality.mark_duplicates(df.repartition(16)).where(~F.col("is_duplicate"))
    assert kept.count() == 3002
    special = kept.where("trip_id = 'hot' OR trip_id IS NULL").orderBy("row_ord").collect()
    assert [r["row_ord"] for r in special] == [1, 2]


def test_many_repeated_ids(spark):
    df = spark.range(2000).select(F.col("id").alias("row_ord"), (F.col("id") % 500).cast("string").alias("trip_id"))
    assert quality.mark_duplicates(df).where("is_duplicate").count() == 1500


def test_clean_and_quarantine_cover_the_input(spark):
    df = trips(spark, {}, {"pickup_lat": None}, {"passenger_count": 0, "eta_minutes": -1.0}, {"trip_id": "t0"})
    flagged = quality.flag_rows(df)
    clean, bad = quality.clean_rows(flagged), quality.quarantine_rows(flagged).drop("reasons")
    both = clean.unionByName(bad)
    assert both.exceptAll(df).isEmpty() and df.exceptAll(both).isEmpty()
    report = quality.validation_report(flagged).first()
    assert report["clean_rows"] + report["quarantine_rows"] == report["total_rows"] == 4
    counters = sum(report[c] for c in quality.RULE_COUNTERS.values())
    assert counters == 5 and report["quarantine_rows"] == 3  # two rows fail two rules each
    assert report["pass_rate"] == 0.25


def test_empty_input(spark):
    report = quality.validation_report(quality.flag_rows(trips(spark, {}).where("false"))).first()
    assert report["total_rows"] == 0 and report["pass_rate"] == 0.0 and report["schema_errors"] == []


def test_missing_columns_stop_the_run(spark):
    df = trips(spark, {}).drop("vendor_id")
    assert quality.schema_errors(df) == ["missing required column: vendor_id"]
    with pytest.raises(quality.ValidationFailed, match="vendor_id"):
        quality.require_columns(df)


def test_pass_rate_gate(spark):
    flagged = quality.flag_rows(trips(spark, {}, {"eta_minutes": -1.0}))
    report = quality.validation_report(flagged)
    quality.require_pass_rate(report, 0.5)
    with pytest.raises(quality.ValidationFailed, match="50.0% is below 80%"):
        quality.require_pass_rate(report)
