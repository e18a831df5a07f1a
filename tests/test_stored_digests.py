"""Hashes and drift from what was stored with the data, against reading the data again."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripkit.operators import monitoring
from tripkit.operators.content import hash_text
from tripkit.sources import versions
from tripkit.streaming import partials


def test_hash_after_three_appends_is_that_of_the_whole(spark, tmp_path):
    base = str(tmp_path)
    whole = spark.range(1000).selectExpr("id AS a", "CASE WHEN id % 7 > 0 THEN id / 3 END AS b", "array(id, NULL) AS c")
    for low, high in ((0, 1), (1, 600), (600, 1000)):
        versions.append_rows(whole.where(f"a >= {low} AND a < {high}").select("c", "a", "b").select("a", "b", "c"), base)
    versions.append_rows(whole.limit(0), base)
    got = versions.appended_hash(spark, base).first()
    assert (got["n_rows"], got["content_hash"]) == (1000, hash_text(whole)) == (1000, hash_text(versions.read_appended(spark, base)))
    versions.append_rows(whole.limit(1).select("c", "b", "a"), base)  # in another order of columns
    assert versions.appended_hash(spark, base).first()["content_hash"] == hash_text(whole.union(whole.limit(1)))
    with pytest.raises(ValueError):
        versions.append_rows(whole.drop("c"), base)


def test_rows_of_an_unlisted_append_are_not_read(spark, tmp_path):
    base = str(tmp_path)
    assert versions.appended_hash(spark, base).first()["n_rows"] == 0
    with pytest.raises(FileNotFoundError):
        versions.read_appended(spark, base)
    versions.append_rows(spark.range(5), base)
    spark.range(9).write.parquet(f"{base}/rows/append_id=half")
    assert versions.read_appended(spark, base).count() == versions.appended_hash(spark, base).first()["n_rows"] == 5


def values(spark, n, shift):
    start = datetime(2016, 1, 1)
    rows = [(start + timedelta(hours=k) if k % 50 else None, float(k % 97) + shift, None if k % 9 == 0 else float("nan") if k % 10 == 0 else float(k % 5), None)
            for k in range(n)]
    return spark.createDataFrame(rows, "at timestamp, a double, b double, unknown double")


def test_stored_profile_gives_the_same_drift(spark, tmp_path):
    old, new = values(spark, 500, 0.0), values(spark, 300, 30.0)
    columns = ["a", "b", "unknown"]
    versions.store_baseline(monitoring.baseline_profile(old, columns), str(tmp_path), "v1")
    profile = versions.load_baseline(spark, str(tmp_path), "v1")
    assert profile.count() == 20 and profile.agg(F.sum("n_rows")).first()[0] == 500 + old.where("b IS NOT NULL AND NOT isnan(b)").count()
    got = {r["column"]: r["psi"] for r in monitoring.drift_from(profile, new).collect()}
    assert got == {r["column"]: r["psi"] for r in monitoring.drift(old, new, columns).collect()} and set(got) == {"a", "b"}
    assert got["a"] > 0.25 > got["b"]
    assert all(r["psi"] > 1 for r in monitoring.drift_from(profile, new.limit(0)).collect())
    assert monitoring.drift(old, new, ["unknown"]).collect() == []


def test_drift_of_a_stream_equals_that_of_each_window(spark, tmp_path):
    profile = monitoring.baseline_profile(values(spark, 500, 0.0), ["a", "b", "unknown"])
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [values(spark, 200, 0.0), values(spark, 300, 40.0)]
    for part in parts:  # a restart between the two
        part.repartition(3).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(part.schema).parquet(folder)
        partials.monitor_drift(stream, profile, "at", out, "2 days").awaitTermination()
    got = {(r["window_start"], r["column"]): r["psi"] for r in partials.read_drift(spark, out, profile).collect()}
    all_ = parts[0].union(parts[1]).where("at IS NOT NULL").withColumn("w", F.window("at", "2 days")["start"])
    want = {}
    for w in [r["w"] for r in all_.select("w").distinct().collect()]:
        for r in monitoring.drift_from(profile, all_.where(F.col("w") == w)).collect():
            want[w, r["column"]] = r["psi"]
    assert got == pytest.approx(want) and len(got) > 10
