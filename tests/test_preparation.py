"""Splits, encoders, imputation, scalers, bins, and versions."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tripkit.operators import prep, splitting
from tripkit.plans import prepare
from tripkit.sources import versions


def test_published_split_sizes():
    assert splitting.split_sizes(99_771) == {"train": 69_839, "val": 9_977, "test": 19_955}
    assert splitting.split_sizes(9_979) == {"train": 6_985, "val": 998, "test": 1_996}


def shares(counts, take):
    """Largest remainder on whole numbers of any size, equal ones by key."""
    total = sum(counts.values())
    if not total:
        return dict.fromkeys(counts, 0)
    found = {k: c * take // total for k, c in counts.items()}
    for k in sorted(counts, key=lambda k: (-(counts[k] * take % total), k))[: take - sum(found.values())]:
        found[k] += 1
    return found


@pytest.mark.parametrize("sizes", [
    [17, 3, 101], [1], [2, 2, 2, 2, 2, 2], [10**12, 3 * 10**13 + 7, 10**17, 1], [k % 7 + 1 for k in range(400)],
])
def test_quotas_follow_the_largest_remainder(spark, sizes):
    counts = dict(enumerate(sizes))
    got = splitting.stratum_quotas(spark.createDataFrame(list(counts.items()), "stratum int, n bigint"), sum(sizes), 0.2, 0.1)
    want = splitting.split_sizes(sum(sizes))
    kept = shares(counts, want["train"] + want["val"])
    train = shares(kept, want["train"])
    rows = {r["stratum"]: (r["n_test"], r["n_val"]) for r in got.collect()}
    assert rows == {k: (counts[k] - kept[k], kept[k] - train[k]) for k in counts}
    assert sum(t for t, _ in rows.values()) == want["test"] and sum(v for _, v in rows.values()) == want["val"]


def test_exact_split_of_a_hundred_thousand_strata(spark):
    """All strata but one have one to three rows; the last one has a third of all."""
    df = spark.range(300_000).select(
        F.col("id").alias("row_ord"), F.col("id").cast("string").alias("trip_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 100_003).cast("string"))).alias("stratum"))
    split = splitting.exact_split(df, "trip_id").toPandas()
    assert split["split"].value_counts().to_dict() == splitting.split_sizes(300_000)
    assert split["row_ord"].nunique() == 300_000 and split["stratum"].nunique() > 90_000
    counts = split.groupby("stratum").size().to_dict()
    sizes = splitting.split_sizes(300_000)
    kept = shares(counts, sizes["train"] + sizes["val"])
    got = split[split["split"] == "test"].groupby("stratum").size()
    assert {k: n for k, n in ((k, counts[k] - kept[k]) for k in counts) if n} == got.to_dict()


def test_exact_split_without_rows_or_with_null_strata(spark):
    assert splitting.exact_split(numbered(spark, 0), "trip_id").count() == 0
    assert [r["split"] for r in splitting.exact_split(numbered(spark, 1), "trip_id").collect()] == ["test"]
    with pytest.raises(ValueError, match="nulls"):
        splitting.exact_split(numbered(spark, 9).withColumn("stratum", F.lit(None).cast("int")), "trip_id")


@pytest.mark.parametrize("values", [
    np.arange(1000) / 7.0, np.repeat([1.0, 1.0, 2.0, 3.0], 250), np.r_[np.zeros(900), np.arange(100)],
])
def test_strata_equal_pandas_qcut(spark, values):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, eta_minutes double")
    got = splitting.add_strata(df).orderBy("i").toPandas()["stratum"]
    want = pd.qcut(pd.Series(values), 5, labels=False, duplicates="drop")
    assert got.tolist() == want.tolist()


def numbered(spark, n, key="CAST(id AS STRING)"):
    return spark.range(n).select(
        F.col("id").alias("row_ord"), F.expr(key).alias("trip_id"), (F.col("id") % 3).cast("int").alias("stratum"))


def test_exact_split_sizes_cover_and_repeat(spark):
    df = numbered(spark, 1003)
    split = splitting.exact_split(df, "trip_id")
    sizes = {r["split"]: r["n_rows"] for r in splitting.split_counts(split).collect()}
    assert sizes == splitting.split_sizes(1003)
    assert split.drop("split").exceptAll(df).isEmpty() and df.exceptAll(split.drop("split")).isEmpty()
    again = splitting.exact_split(df.repartition(11), "trip_id")
    assert split.exceptAll(again).isEmpty()
    per = split.groupBy("stratum").pivot("split").count().toPandas()
    assert (per["test"] - 1003 / 15).abs().max() <= 1.0


def test_exact_split_when_one_key_holds_a_third_of_the_rows(spark):
    df = numbered(spark, 3000, "CASE WHEN id % 3 = 1 THEN 'hot' ELSE CAST(id AS STRING) END")
    split = splitting.exact_split(df, "trip_id")
    assert {r["split"]: r["n_rows"] for r in splitting.split_counts(split).collect()} == splitting.split_sizes(3000)
    hot = split.where("trip_id = 'hot'").groupBy("split").agg(F.min("row_ord"), F.max("row_ord")).collect()
    spans = {r["split"]: (r[1], r[2]) for r in hot}
    assert spans["test"][1] < spans["val"][0] <= spans["val"][1] < spans["train"][0]


def test_cover_tells_what_is_shared_foreign_or_missing(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "row_ord bigint")
    split = spark.createDataFrame([(1, "train"), (1, "test"), (2, "train"), (2, "train"), (9, "val")], "row_ord bigint, split string")
    rows = {r["split"]: tuple(r)[1:] for r in splitting.split_cover(df, split).collect()}
    assert rows == {"train": (2, 1, 0), "test": (1, 1, 0), "val": (1, 0, 1), None: (2, 0, 0)}


def test_time_split_breaks_ties_by_input_order(spark):
    df = spark.range(100).select(
        F.col("id").alias("row_ord"),
        F.timestamp_add("DAY", F.when(F.col("id") < 30, 0).otherwise(5), F.lit("2016-01-01").cast("timestamp_ntz")
                        ).alias("pickup_datetime"))
    split = splitting.time_split(df.repartition(7))
    train = sorted(r["row_ord"] for r in split.where("split = 'train'").collect())
    assert train == list(range(80))


def test_hash_split_is_stable_when_rows_are_added(spark):
    few, more = numbered(spark, 500), numbered(spark, 800)
    a = splitting.hash_split(few, "trip_id")
    b = splitting.hash_split(more, "trip_id")
    assert a.exceptAll(b).isEmpty()
    share = b.where("split = 'test'").count() / 800
    assert 0.15 < share < 0.25


# ----------------------------------------------------------------------- encoders


def test_ordinal_codes_and_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "v string")
    other = spark.createDataFrame([(0, "c"), (1, "zz"), (2, None), (3, "a")], "i int, v string")
    codes = prep.fit_categories(train, ["v"])
    rows = prep.ordinal_encode(other, codes, ["v"]).orderBy("i").collect()
    assert [r["v"] for r in rows] == [2.0, -1.0, -1.0, 0.0]


def test_onehot_drops_the_first_category(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "v string")
    other = spark.createDataFrame([(0, "a"), (1, "c"), (2, "zz"), (3, None)], "i int, v string")
    table = prep.onehot_encode(other, prep.fit_categories(train, ["v"]), ["v"]).orderBy("i")
    assert table.columns == ["i", "v_b", "v_c"]
    assert [tuple(r)[1:] for r in table.collect()] == [(0, 0), (0, 1), (0, 0), (0, 0)]


def test_sparse_onehot_equals_the_wide_form(spark):
    train = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", None), ("b", "z")], "v string, w string")
    other = spark.createDataFrame([(0, "a", "z", 1), (1, "c", "x", 2), (2, "zz", "y", 3), (3, None, None, 4), (3, "b", "z", 5)], "i int, v string, w string, onehot int")
    codes = prep.fit_categories(train, ["v", "w"])
    wide = prep.onehot_encode(other, codes, ["v", "w"]).orderBy("onehot").drop("i", "onehot").collect()
    table = prep.onehot_sparse(other, codes, ["v", "w"], "ones").orderBy("onehot")
    assert table.columns == ["i", "onehot", "ones"]
    got = [r.ones for r in table.collect()]
    assert [[float(k in o.indices) for k in range(o.size)] for o in got] == [list(r) for r in wide]
    assert all(o.indices == sorted(o.indices) for o in got)
    nothing = prep.onehot_sparse(other, codes.limit(0), ["v"], "ones").first().ones
    assert (nothing.size, nothing.indices) == (0, [])


def test_sparse_onehot_of_very_many_categories(spark):
    df = spark.range(100_000).selectExpr("id", "CAST(id AS STRING) AS v")
    table = prep.onehot_sparse(df, prep.fit_categories(df, ["v"]), ["v"])
    row = table.agg(F.count_distinct("onehot.indices").alias("n"), F.max(F.size("onehot.indices")).alias("most"), F.max("onehot.size").alias("size")).first()
    assert (row.n, row.most, row.size) == (100_000, 1, 99_999)


def test_unknown_choices_are_errors(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError, match="unknown scaler 'log'"):
        prep.fit_scaler(df, ["x"], "log")
    with pytest.raises(ValueError, match="unknown encoder 'hash'"):
        prepare.fit_prep(df, encoder="hash")


@pytest.mark.parametrize("kind, want", [
    ("standard", [-1.0690449676496976, -0.2672612419124244, 1.336306209562122]),
    ("minmax", [0.0, 1 / 3, 1.0]),
    ("robust", [-2 / 3, 0.0, 4 / 3]),
])
def test_scalers(spark, kind, want):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (4.0, 7.0)], "x double, flat double")
    fitted = prep.fit_scaler(df, ["x", "flat"], kind)
    rows = prep.scale(df, fitted).orderBy("x").collect()
    np.testing.assert_allclose([r["x"] for r in rows], want)
    assert [r["flat"] for r in rows] == [0.0, 0.0, 0.0]


def test_medians_come_from_train_only(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),)], "x double")
    medians = prep.fit_medians(train, ["x"])
    assert medians == {"x": 2.0}
    other = spark.createDataFrame([(100.0,), (None,)], "x double")
    assert sorted(r["x"] for r in prep.impute(other, medians).collect()) == [2.0, 100.0]


def test_bins_follow_the_published_convention(spark):
    train = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    edges = prep.fit_bins(train, ["x"])
    assert len(edges["x"]) == 11 and edges["x"][0] == pytest.approx(-0.01) and edges["x"][1:3] == [1.0, 2.0]
    test = spark.createDataFrame([(v,) for v in (-5.0, 0.0, 1.0, 1.1, 10.0, 99.0, None)], "x double")
    assert [r["x_bin"] for r in prep.apply_bins(test, edges).collect()] == [0, 0, 0, 1, 9, 9, None]


# ----------------------------------------------------------------------- versions


def trip_table(spark, n=400):
    from datetime import datetime

    return spark.range(n).select(
        F.col("id").alias("row_ord"), F.col("id").cast("string").alias("trip_id"),
        (F.col("id") % 2 + 1).cast("int").alias("vendor_id"), (F.col("id") % 6 + 1).cast("int").alias("passenger_count"),
        F.timestamp_add("MINUTE", (F.col("id") * 37).cast("int"), F.lit(datetime(2016, 1, 1)).cast("timestamp_ntz")
                        ).alias("pickup_datetime"),
        (40.6 + (F.col("id") * 13 % 100) / 500).alias("pickup_lat"), (-74.1 + (F.col("id") * 7 % 100) / 400).alias("pickup_lon"),
        (40.6 + (F.col("id") * 29 % 100) / 500).alias("dropoff_lat"), (-74.1 + (F.col("id") * 3 % 100) / 400).alias("dropoff_lon"),
        F.lit("N").alias("store_and_fwd_flag"), F.when(F.col("id") % 4 == 0, "x").otherwise("y").alias("zone"),
        (5 + F.col("id") * 11 % 50).cast("double").alias("eta_minutes"),
    )


@pytest.mark.parametrize("encoder, scaler, mode", [
    ("ordinal", "standard", "hash"), ("onehot", "minmax", "exact"), ("ordinal", "robust", "time"),
])
def test_prepare_write_and_reload(spark, tmp_path, encoder, scaler, mode):
    base = str(tmp_path / "versions")
    version, fitted = prepare.prepare_and_version(trip_table(spark), base, encoder, scaler, mode)
    assert version == "v1"
    stored = versions.load_version(spark, base, version)
    meta = stored["metadata"]
    assert meta["scaler_type"] == scaler and meta["encoder_type"] == encoder
    assert meta["n_train"] + meta["n_val"] + meta["n_test"] == 400
    assert stored["train"].count() == meta["n_train"]
    if mode == "exact":
        assert (meta["n_train"], meta["n_val"], meta["n_test"]) == (280, 40, 80)
    names = fitted.feature_names
    assert names[-1] == ("zone_y" if encoder == "onehot" else "zone")
    assert set(stored["train"].columns) == {*names, "eta_minutes"}
    again = prepare.load_prep(spark, base, version)
    assert (again.feature_names, again.medians, again.scaler) == (names, fitted.medians, fitted.scaler)
    features = prepare.build_features(trip_table(spark))
    assert again.apply(features).select(*names).exceptAll(fitted.apply(features).select(*names)).isEmpty()


def test_statistics_ignore_validation_and_test_rows(spark):
    table = splitting.hash_split(trip_table(spark), "trip_id")
    changed = table.withColumn(
        "passenger_count", F.when(F.col("split") == "train", F.col("passenger_count")).otherwise(1000))
    fits = [
        prepare.fit_prep(prepare.build_features(t).where("split = 'train'")) for t in (table, changed)
    ]
    assert fits[0].medians == fits[1].medians and fits[0].scaler == fits[1].scaler


def test_versions_count_up_and_are_immutable(spark, tmp_path):
    base = str(tmp_path / "v")
    table = spark.createDataFrame([(1.0, "train"), (2.0, "test")], "x double, split string")
    assert [versions.write_version(table, base, {}) for _ in range(2)] == ["v1", "v2"]
    assert versions.next_version(versions.read_metadata(spark, base)).first()[0] == "v3"
    with pytest.raises(AnalysisException):
        versions.write_version(table, base, {}, version="v2")
    with pytest.raises(FileNotFoundError):
        versions.load_version(spark, base, "v9")


def test_version_order_is_numeric(spark):
    names = spark.createDataFrame([("v9",), ("v10",), ("vx",), ("tmp",)], "version string")
    assert versions.next_version(names).first()[0] == "v11"
    assert versions.latest_version(names).first()["version"] == "v10"
    assert versions.next_version(names.where("false")).first()[0] == "v1"
    assert versions.latest_version(names.where("false")).count() == 0


def test_snapshots_and_latest_per_source(spark, tmp_path):
    base = str(tmp_path / "s")
    table = spark.createDataFrame([(1, "a")], "x int, y string")
    first = versions.write_snapshot(table, base, "one", {"rows_in": 1})
    second = versions.write_snapshot(table.withColumn("x", F.lit(2)), base, "two")
    latest = {r["source_description"]: r["version_id"] for r in versions.latest_per_source(versions.read_snapshots(spark, base)).collect()}
    assert latest == {"one": first, "two": second}
    assert spark.read.parquet(f"{base}/{second}.parquet").first()["x"] == 2
