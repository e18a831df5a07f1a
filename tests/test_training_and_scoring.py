"""Search, comparison, whole runs, request scoring."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from catalogue import runs
from test_preparation import trip_table
from tripkit.operators import metrics, quality, scoring
from tripkit.plans import end_to_end, first_generation, training
from tripkit.plans.score import load_scorer
from tripkit.plans.training import Family, Real, Whole
from tripkit.schema import REQUEST_SCHEMA
from tripkit.sources import tracking, versions


def test_trial_counts():
    assert training.trial_count({"a": [1, 2]}) == 2
    assert training.trial_count({"a": [1, 2, 3], "b": [1, 2], "c": [1, 2, 3]}) == 12
    assert training.trial_count({"a": [1], "b": Real(0, 1)}) == 12


def test_draws_are_reproducible_and_in_range():
    space = {"depth": [3, 5], "leaf": Whole(1, 20), "gain": Real(0.0, 0.01)}
    first = training.draw_params(space, 12, 1)
    assert first == training.draw_params(space, 12, 1) != training.draw_params(space, 12, 2)
    assert len(first) == 12
    assert all(p["depth"] in (3, 5) and 1 <= p["leaf"] < 20 and 0 <= p["gain"] < 0.01 for p in first)
    assert training.draw_params({"a": [1, 2], "b": [3, 4]}) == [
        {"a": 1, "b": 3}, {"a": 1, "b": 4}, {"a": 2, "b": 3}, {"a": 2, "b": 4}]


def test_all_families_can_be_built():
    families = training.model_families()
    assert list(families)[:3] == ["linear_regression", "decision_tree", "gradient_boosting"]
    for family in [*families.values(), training.random_forest_family()]:
        for params in training.draw_params(family.space, 3):
            training._with_params(family.estimator(), params)


def test_rounds_to_keep():
    falling = [9.0, 8.0, 7.0]
    assert training.rounds_to_keep(falling, 2) == (3, False)
    assert training.rounds_to_keep([*falling, 7.0, 7.5], 2) == (3, True)
    assert training.rounds_to_keep([*falling, 7.5, 6.0, 7.0], 2) == (5, False)
    assert training.rounds_to_keep([*falling, 7.5, 7.5, 1.0], 2) == (3, True)
    assert training.rounds_to_keep([1.0, 2.0], 15) == (1, False)


def noisy(spark, n=600):
    """Labels that follow one feature, with noise that trees fit if they go on for long."""
    rng = np.random.default_rng(7)
    x = rng.uniform(0, 10, (n, 3))
    y = np.sin(x[:, 0]) * 3 + rng.normal(0, 2.0, n)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    return training.with_folds(training.assemble(df, ["a", "b", "c"], "y"), 3).persist()


def test_boosting_stops_as_a_count_from_the_staged_errors(spark, tmp_path):
    data = noisy(spark)
    common = {"featuresCol": "features", "labelCol": "label", "seed": 3, "stepSize": 0.3, "maxDepth": 4, "maxIter": 80}
    model = training.PatientBoosting(validationIndicatorCol="early_stop", **common).fit(data)
    # brute force: all rounds on the unwatched rows, the sum of the first k trees on the watched ones
    whole = GBTRegressor(**common).fit(data.where("NOT early_stop"))
    held = data.where("early_stop").collect()
    staged, total = [], np.zeros(len(held))
    for tree, weight in zip(whole.trees, whole.treeWeights):
        total = total + weight * np.array([tree.predict(r["features"]) for r in held])
        staged.append(np.mean((total - np.array([r["label"] for r in held])) ** 2))
    end = next(k for k in range(len(staged)) if k - int(np.argmin(staged[: k + 1])) >= training.PATIENCE)
    want = int(np.argmin(staged[: end + 1])) + 1
    assert model.getNumTrees == want < 60
    first = [sum(w * t.predict(r["features"]) for t, w in list(zip(whole.trees, whole.treeWeights))[:want]) for r in held]
    got = [r["prediction"] for r in model.transform(data.where("early_stop")).collect()]
    np.testing.assert_allclose(np.sort(got), np.sort(first), rtol=1e-9)
    assert len(model.featureImportances) == 3
    model.write().save(str(tmp_path / "model"))
    loaded = type(model).load(str(tmp_path / "model"))
    assert loaded.getNumTrees == want and loaded.getFeaturesCol() == "features"


def test_boosting_without_watched_rows_keeps_all_rounds(spark):
    data = noisy(spark, 100).withColumn("early_stop", F.lit(False))
    model = training.PatientBoosting(
        validationIndicatorCol="early_stop", maxIter=3, maxDepth=2, featuresCol="features", labelCol="label").fit(data)
    assert model.getNumTrees == 3


def test_metrics_of_a_constant_label(spark):
    df = spark.createDataFrame([("m", 5.0, 4.0), ("m", 5.0, 6.0)], "model string, label double, prediction double")
    row = metrics.regression_metrics(df, ["model"]).first()
    assert (row["mae"], row["rmse"], row["r2"]) == (1.0, 1.0, None)


def test_champion_takes_the_first_name_on_ties(spark):
    board = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0), ("d", None)], "model string, val_rmse double")
    assert metrics.champion(board).first()["model"] == "a"


def test_trial_ranks_share_ties(spark):
    scores = spark.createDataFrame(
        [("m", t, k, s) for t, s in ((0, 2.0), (1, 1.0), (2, 1.0), (3, 3.0)) for k in range(2)],
        "model string, trial int, fold int, rmse double")
    rows = {r["trial"]: r["rank_test_score"] for r in metrics.trial_table(scores, ["model", "trial"], 2).collect()}
    assert rows == {0: 3, 1: 1, 2: 1, 3: 4}


def small_families():
    common = {"featuresCol": "features", "labelCol": "label"}
    return {
        "linear_regression": training.model_families()["linear_regression"],
        "decision_tree": Family(lambda: DecisionTreeRegressor(seed=1, **common), {"maxDepth": Whole(2, 6)}),
        "gradient_boosting": Family(
            lambda: GBTRegressor(seed=1, maxIter=3, validationIndicatorCol="early_stop", **common), {"maxDepth": [2, 3]}),
    }


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    """One whole run on trips whose duration depends on the distance and the hour."""
    from tripkit.plans.features import build_features

    base = str(tmp_path_factory.mktemp("run"))
    trips = trip_table(spark, 1500).drop("eta_minutes", "zone").withColumn(
        "dropoff_datetime", F.timestamp_add("MINUTE", F.lit(9), F.col("pickup_datetime")))
    minutes = build_features(trips).select("row_ord", (3 + F.col("haversine_km") + F.col("hour_of_day") / 4).alias("eta_minutes"))
    trips = trips.join(minutes, "row_ord").withColumn(
        "passenger_count", F.when(F.col("row_ord") % 100 == 0, 0).otherwise(F.col("passenger_count")))
    result = end_to_end.run(
        spark, base, trips, None, families=small_families(), draws=2, folds=2)
    return base, result


def test_whole_run(spark, finished):
    base, result = finished
    assert result.report["quarantine_rows"] == 15 and result.version == "v1" and result.profile_failures == {}
    assert result.split_sizes == {"train": 1039, "val": 149, "test": 297}
    board = result.comparison.leaderboard.collect()
    assert [r["val_rmse"] for r in board] == sorted(r["val_rmse"] for r in board) and len(board) == 3
    assert result.comparison.champion.name == board[0]["model"] == "linear_regression"
    assert result.comparison.champion.test_metrics["test_r2"] > 0.95
    assert [r.test_metrics for r in result.comparison.results if r.name != board[0]["model"]] == [{}, {}]
    assert result.comparison.gaps.count() == 3
    keys = {r["key"] for r in tracking.read_metrics(spark, base).collect()}
    assert {"invalid_passenger_rows", "target_skewness", "content_hash", "test_rmse", "elapsed_sec"} <= keys
    trials = spark.read.csv(f"{base}/trials/run={result.run_id}/linear_regression", header=True).collect()
    assert [int(r["rank_test_score"]) for r in trials] == [1, 2] and "True" in trials[0]["params"]
    importance = spark.read.json(f"{base}/importance/run={result.run_id}/decision_tree")
    assert 0 < importance.count() <= 20


class Asked(Exception):
    """Carries what a run was asked for, in place of the run."""


def test_whole_run_query_searches_the_published_budget(spark, tmp_path, monkeypatch):
    orders = [(k, f"1995-01-{1 + k:02d}", 1000.0 * k) for k in range(20)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate string, o_totalprice double").withColumn(
        "o_orderdate", F.to_timestamp("o_orderdate")).write.parquet(str(tmp_path / "orders.parquet"))

    def ask(spark, base, trips, weather=None, **options):
        raise Asked(options)

    monkeypatch.setattr(end_to_end, "run", ask)
    with pytest.raises(Asked) as asked:
        runs.whole_run(spark, str(tmp_path))
    options = {k: v for k, v in asked.value.args[0].items() if k != "minimum_pass_rate"}
    assert not options.pop("skip_train", False) and not options.pop("skip_eda", False)

    # the same search with every learner cut to one split, so that only its extent is held
    tried = []

    def stump(estimator, params):
        tried.append(params)
        small = {"maxDepth": 1, "maxIter": 1} if "maxDepth" in params else {}
        return estimator.copy({estimator.getParam(k): v for k, v in small.items() if estimator.hasParam(k)})

    monkeypatch.setattr(training, "_with_params", stump)
    rng = np.random.default_rng(3)
    rows = [(float(x), float(x + e), "val" if k % 5 == 0 else "train")
            for k, (x, e) in enumerate(zip(rng.uniform(0, 9, 200), rng.normal(0, 1, 200)))]
    table = spark.createDataFrame(rows, "a double, y double, split string")
    comparison = training.compare(training.assemble(table, ["a"], "y", keep=["split"]), **options)
    published = training.model_families()
    assert [r.name for r in comparison.results] == list(published)
    extent = {"linear_regression": 2, "decision_tree": 12, "gradient_boosting": 12}
    for r in comparison.results:
        want = training.draw_params(published[r.name].space)
        trials = r.trials.collect()
        assert sorted(t["params"] for t in trials) == sorted(map(str, want)) and len(trials) == extent.get(r.name, 12)
        assert {c for c in r.trials.columns if c.startswith("split")} == {f"split{k}_test_score" for k in range(3)}
    wanted = [p for f in published.values() for p in training.draw_params(f.space)]
    assert all(tried.count(p) >= 3 for p in wanted)  # a fit per fold, and the best one again
    assert len(tried) == 3 * len(wanted) + len(published)


def test_scoring_with_the_stored_model(spark, finished):
    base, result = finished
    scorer = load_scorer(spark, base)
    assert (scorer.model_version, scorer.dataset_version) == ("1", "v1")
    rows = [
        (0, "2016-01-05T08:30:00", 40.7, -74.0, 40.75, -73.95, 1, 1, "N", None, None, None, None),
        (1, "2016-01-05 08:30:00", 40.7, -74.0, 40.75, -73.95, None, None, None, None, None, None, None),
        (2, "2016-01-05 08:30:00", 10.0, -74.0, 40.75, -73.95, 9, 1, "Z", None, None, None, None),
        (3, "whenever", 40.7, -74.0, 40.75, -73.95, 1, 1, "N", "soon", None, -1.0, None),
    ]
    requests = spark.createDataFrame(rows, REQUEST_SCHEMA)
    out = {r["request_ord"]: r for r in scorer.score(requests).collect()}
    assert len(out) == 4 and out[0]["error"] is None and out[0]["eta_minutes"] == out[1]["eta_minutes"] > 3
    assert out[0]["input_features"] == 34 and out[0]["eta_seconds"] == pytest.approx(out[0]["eta_minutes"] * 60, abs=1)
    assert out[2]["error"] == "invalid pickup_lat, passenger_count, store_and_fwd_flag"
    assert out[3]["error"] == "invalid pickup_datetime, precipitation, dropoff_datetime"
    assert scorer.identity(spark).first()["dataset_version"] == "v1"


def test_scoring_a_train_row_equals_its_training_prediction(spark, finished):
    base, result = finished
    scorer = load_scorer(spark, base)
    stored = versions.load_version(spark, base, "v1")["data"]
    best = result.comparison.champion
    data = training.assemble(stored, scorer.prep.feature_names, keep=["split"])
    want = np.sort([r["prediction"] for r in best.model.transform(data).collect()])
    clean = spark.read.parquet(f"{base}/ingested/run={result.run_id}").where("outcome = 'clean'").drop("outcome", "reasons")
    got = np.sort([r["prediction"] for r in scorer.predict(clean).collect()])
    np.testing.assert_allclose(got, want, rtol=1e-9)


def test_a_bad_input_stops_the_run(spark, tmp_path):
    trips = trip_table(spark, 50).withColumn("dropoff_datetime", F.col("pickup_datetime"))
    with pytest.raises(quality.ValidationFailed, match="pass rate"):
        end_to_end.run(spark, str(tmp_path), trips, None)


def test_postprocess_floor(spark):
    df = spark.createDataFrame([(-3.0,), (12.3456,)], "prediction double")
    rows = scoring.postprocess(df, "1", "v1", 34).orderBy("prediction").collect()
    assert [(r["eta_minutes"], r["eta_seconds"]) for r in rows] == [(0.1, 6), (12.35, 741)]


def test_request_flags(spark):
    df = spark.createDataFrame([("",), (None,), (" y ",), ("  ",), ("n",), ("q",)], "store_and_fwd_flag string")
    flags = [r[0] for r in df.select(scoring.clean_flag(F.col("store_and_fwd_flag"))).collect()]
    assert flags == ["N", "N", "Y", "", "N", "Q"]


def test_command_line_arguments():
    from tripkit.__main__ import arguments

    args = arguments(["--input", "a.csv", "b.csv", "--base", "/x", "--skip-train"])
    assert args.input == ["a.csv", "b.csv"] and args.skip_train and not args.skip_eda and args.scaler == "standard"


def test_first_generation(spark, tmp_path):
    trips = trip_table(spark, 300).drop("zone", "eta_minutes").withColumns({
        "dropoff_datetime": F.timestamp_add("MINUTE", F.lit(9), F.col("pickup_datetime")),
        "trip_duration_sec": F.when(F.col("row_ord") < 10, 5).otherwise(540), "eta_minutes": F.lit(9.0)})
    out = first_generation.run(trips, str(tmp_path), "test")
    assert out["report"]["total_rows_dropped"] == 10 and out["report"]["drop_rate_pct"] == 3.33
    rows = {r["source_description"]: r["n_rows"] for r in versions.read_snapshots(spark, str(tmp_path)).collect()}
    assert rows == {"test_train_split": 232, "test_test_split": 58}
    assert len(out["edges"]["pickup_lat"]) == 11
