"""Metrics, leaderboard, champion, training and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.quality import clean, stored_clean, stored_enriched
from catalogue.sql import DISTANCE, HOUR, RUSH, row_hash, split_of, using
from tripkit.operators import metrics, splitting
from tripkit.plans import prepare, training
from tripkit.plans.features import build_features
from tripkit.session import materialize

# ------------------------------------------------- metrics of three simple predictors

PREDICTORS = {"by_distance": "8 + 1.5 * haversine_km", "by_hour": "30 + 0.5 * hour_of_day", "constant": "42.0"}


def predictions(spark, sf):
    """Long predictions of three fixed formulas on split clean trips."""
    table = splitting.hash_split(build_features(clean(spark, sf)), "trip_id")
    models = F.array(*[
        F.struct(F.lit(n).alias("model"), F.expr(e).cast("double").alias("prediction")) for n, e in PREDICTORS.items()
    ])
    return table.select("split", F.col("eta_minutes").alias("label"), F.inline(models))


def metric_table(spark, sf):
    return metrics.regression_metrics(predictions(spark, sf), ["model", "split"])


PREDICTED = f"""
f AS (SELECT {split_of('trip_id')} AS split, eta_minutes AS label, {DISTANCE} AS haversine_km, {HOUR} AS hour_of_day FROM clean),
p AS (SELECT split, label, 'by_distance' AS model, 8 + cast(1.5 as double) * haversine_km AS prediction FROM f
      UNION ALL SELECT split, label, 'by_hour', 30 + cast(0.5 as double) * hour_of_day FROM f
      UNION ALL SELECT split, label, 'constant', cast(42 as double) FROM f),
m AS (SELECT model, split, count(*) AS n_rows, round(avg(abs(label - prediction)), 4) AS mae,
             round(sqrt(avg((label - prediction) * (label - prediction))), 4) AS rmse,
             round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 4) AS r2
      FROM p GROUP BY model, split),
b AS (SELECT model, max(mae) FILTER (split = 'val') AS val_mae, max(rmse) FILTER (split = 'val') AS val_rmse,
             max(r2) FILTER (split = 'val') AS val_r2, max(r2) FILTER (split = 'train') AS train_r2 FROM m GROUP BY model)"""


def with_metrics(body: str) -> str:
    return using("flagged", f"WITH {PREDICTED} {body}")


# --------------------------------------------------------------------------- trials


def trial_rank(spark, sf):
    """Fold errors of predictors per vendor-like part of the order table, ranked."""
    from tripkit.functions.keys import row_hash as hash_column

    table = build_features(stored_clean(spark, sf)).withColumn(
        "fold", (hash_column(F.col("trip_id"), 43) % 3).cast("int"))
    guesses = F.array(*[
        F.struct(F.lit(g).alias("guess"), F.lit(float(g)).alias("prediction")) for g in range(20, 70, 5)
    ])
    long = table.select("fold", F.lit("constant").alias("family"), F.col("eta_minutes").alias("label"), F.inline(guesses))
    scores = metrics.regression_metrics(long, ["family", "guess", "fold"], digits=6)
    ranked = metrics.trial_table(scores, ["family", "guess"], 3)
    return ranked.withColumns({c: F.round(c, 5) for c in ("mean_test_score", "std_test_score")})


TRIAL_SQL = using("flagged", f"""
WITH g AS (SELECT CAST(unnest(range(20, 70, 5)) AS INTEGER) AS guess),
s AS (SELECT guess, {row_hash('trip_id', 43)} % 3 AS fold, round(sqrt(avg((eta_minutes - guess) * (eta_minutes - guess))), 6) AS rmse
      FROM clean, g GROUP BY 1, 2),
t AS (SELECT guess, max(rmse) FILTER (fold = 0) AS split0_test_score, max(rmse) FILTER (fold = 1) AS split1_test_score,
             max(rmse) FILTER (fold = 2) AS split2_test_score, avg(rmse) AS m, stddev_pop(rmse) AS d FROM s GROUP BY guess)
SELECT 'constant' AS family, guess, split0_test_score, split1_test_score, split2_test_score,
       round(m, 5) AS mean_test_score, round(d, 5) AS std_test_score,
       CAST(rank() OVER (ORDER BY round(m, 6)) AS INTEGER) AS rank_test_score FROM t""")


# -------------------------------------------------------------------------- training


def two_features(spark, sf):
    table = splitting.hash_split(build_features(stored_clean(spark, sf)), "trip_id")
    return materialize(table.select("trip_id", "haversine_km", "is_rush_hour", "eta_minutes", "split"))


def train_linear(spark, sf):
    """Least squares on two features, fitted on train, scored on all splits."""
    features = ["haversine_km", "is_rush_hour"]
    data = training.assemble(two_features(spark, sf), features, key="trip_id", keep=["split"])
    estimator = training.model_families()["linear_regression"].estimator()
    model = estimator.fit(data.where(F.col("split") == "train"))
    scores = training.split_metrics("linear_regression", model, data, ["train", "val", "test"])
    named = {"intercept": model.intercept, **dict(zip(features, model.coefficients.toArray()))}
    return scores.withColumns({k: F.round(F.lit(float(v)), 5) for k, v in named.items()})


LINEAR_SQL = using("flagged", f"""
WITH f AS (SELECT {split_of('trip_id')} AS split, eta_minutes AS y, {DISTANCE} AS x1, {RUSH} AS x2 FROM clean),
s AS (SELECT var_pop(x1) AS v1, var_pop(x2) AS v2, covar_pop(x1, x2) AS c12, covar_pop(x1, y) AS c1y,
             covar_pop(x2, y) AS c2y, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my FROM f WHERE split = 'train'),
w AS (SELECT (c1y * v2 - c2y * c12) / (v1 * v2 - c12 * c12) AS b1, (c2y * v1 - c1y * c12) / (v1 * v2 - c12 * c12) AS b2,
             m1, m2, my FROM s),
p AS (SELECT f.*, my - b1 * m1 - b2 * m2 AS b0, b1, b2, y - (my - b1 * m1 - b2 * m2 + b1 * x1 + b2 * x2) AS e FROM f, w)
SELECT 'linear_regression' AS model, split, count(*) AS n_rows, round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse,
       round(1 - sum(e * e) / (var_pop(y) * count(*)), 4) AS r2, round(b0, 5) AS intercept,
       round(b1, 5) AS haversine_km, round(b2, 5) AS is_rush_hour
FROM p GROUP BY split, b0, b1, b2""")


def search_linear(spark, sf):
    """Cross-validated search with and without an intercept on one feature."""
    table = two_features(spark, sf).where(F.col("split") == "train")
    data = training.assemble(table, ["haversine_km"], key="trip_id")
    _, _, trials = training.search(
        "linear_regression", training.model_families()["linear_regression"], data)
    return trials.select(
        F.col("params").contains("True").alias("fit_intercept"),
        *[F.round(c, 4).alias(c) for c in (
            "split0_test_score", "split1_test_score", "split2_test_score", "mean_test_score", "mean_train_score")],
        "rank_test_score")


def search_sql() -> str:
    folds = []
    for k in range(3):
        folds.append(f"""
          SELECT {k} AS fold, fit, sqrt(avg((y - a - b * x) * (y - a - b * x)) FILTER (fold = {k})) AS test,
                 sqrt(avg((y - a - b * x) * (y - a - b * x)) FILTER (fold <> {k})) AS train
          FROM f, (SELECT true AS fit, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM f WHERE fold <> {k}
                   UNION ALL SELECT false, sum(x * y) / sum(x * x), 0 FROM f WHERE fold <> {k})
          GROUP BY fit""")
    return using("flagged", f"""
      WITH f AS (SELECT {row_hash('trip_id', 43)} % 3 AS fold, eta_minutes AS y, {DISTANCE} AS x FROM clean
                 WHERE {split_of('trip_id')} = 'train'),
      s AS ({' UNION ALL '.join(folds)})
      SELECT fit AS fit_intercept, round(max(test) FILTER (fold = 0), 4) AS split0_test_score,
             round(max(test) FILTER (fold = 1), 4) AS split1_test_score,
             round(max(test) FILTER (fold = 2), 4) AS split2_test_score, round(avg(test), 4) AS mean_test_score,
             round(avg(train), 4) AS mean_train_score, CAST(rank() OVER (ORDER BY avg(test)) AS INTEGER) AS rank_test_score
      FROM s GROUP BY fit""")


def train_stump(spark, sf):
    """Trees of one split on the pickup hour: a single tree, and one round of boosting."""
    from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor

    table = splitting.hash_split(build_features(stored_clean(spark, sf)), "trip_id")
    slim = materialize(table.select("trip_id", "hour_of_day", "eta_minutes", "split"))
    data = training.assemble(slim, ["hour_of_day"], key="trip_id", keep=["split"])
    train = data.where(F.col("split") == "train")
    common = {"featuresCol": "features", "labelCol": "label", "maxDepth": 1, "seed": 42}
    models = {
        "decision_tree": DecisionTreeRegressor(**common), "gradient_boosting": GBTRegressor(maxIter=1, **common),
    }
    tables = [
        training.split_metrics(name, estimator.fit(train), data, ["train", "val", "test"])
        for name, estimator in models.items()
    ]
    return tables[0].unionByName(tables[1])


# Best cut of the 24 hours by the sum of squares it explains; leaves predict their mean.
STUMP_SQL = using("flagged", f"""
WITH f AS (SELECT {split_of('trip_id')} AS split, eta_minutes AS y, {HOUR} AS h FROM clean),
g AS (SELECT t, avg(y) FILTER (h <= t) AS low, avg(y) FILTER (h > t) AS high,
             sum(y) FILTER (h <= t) * avg(y) FILTER (h <= t) + sum(y) FILTER (h > t) * avg(y) FILTER (h > t) AS gain
      FROM f, (SELECT unnest(range(23)) AS t) WHERE split = 'train' GROUP BY t),
b AS (SELECT t, low, high FROM g ORDER BY gain DESC LIMIT 1),
p AS (SELECT split, y, y - CASE WHEN h <= t THEN low ELSE high END AS e FROM f, b),
m AS (SELECT split, count(*) AS n_rows, round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse,
             round(1 - sum(e * e) / (var_pop(y) * count(*)), 4) AS r2 FROM p GROUP BY split)
SELECT 'decision_tree' AS model, * FROM m UNION ALL SELECT 'gradient_boosting', * FROM m""")


def prepared(spark, sf):
    table, fitted = prepare.prepare(stored_enriched(spark, sf))
    return training.assemble(materialize(table), fitted.feature_names, keep=["split"]), fitted


def train_tree(spark, sf):
    """A regression tree on all prepared features."""
    from pyspark.ml.regression import DecisionTreeRegressor

    data, _ = prepared(spark, sf)
    model = DecisionTreeRegressor(featuresCol="features", labelCol="label", maxDepth=5, seed=42).fit(
        data.where(F.col("split") == "train"))
    return training.split_metrics("decision_tree", model, data, ["train", "val", "test"])


def train_gbt(spark, sf):
    """Boosted trees that stop early on a watched tenth of the train rows."""
    from pyspark.ml.regression import GBTRegressor

    data, _ = prepared(spark, sf)
    train = training.with_folds(data.where(F.col("split") == "train"), 3)
    model = GBTRegressor(
        featuresCol="features", labelCol="label", validationIndicatorCol="early_stop", maxIter=10, maxDepth=4, seed=42,
    ).fit(train)
    return training.split_metrics("gradient_boosting", model, data, ["train", "val", "test"])


def boosting_patience(spark, sf):
    """Boosted trees on the prepared features with the published patience: the error on the watched tenth after each round
    kept, and whether a later one was better. The kept ensemble ends at its best round."""
    data, _ = prepared(spark, sf)
    train = training.with_folds(data.where(F.col("split") == "train"), 3).persist()
    boosting = training.model_families()["gradient_boosting"].estimator()
    model = boosting.copy({boosting.maxIter: 100, boosting.maxDepth: 3, boosting.minInstancesPerNode: 10}).fit(train)
    errors = model.evaluateEachIteration(train.where("early_stop"), "squared")
    train.unpersist()
    rows = [(number, float(error), error == min(errors)) for number, error in enumerate(errors, 1)]
    return spark.createDataFrame(rows, "round int, squared_error double, best boolean")


def feature_importance(spark, sf):
    """Twenty largest importances of a forest, the earlier comparison's family."""
    from pyspark.ml.regression import RandomForestRegressor

    data, fitted = prepared(spark, sf)
    model = RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=10, maxDepth=5, seed=42).fit(
        data.where(F.col("split") == "train"))
    return training.feature_importance(model, fitted.feature_names, spark)


QUERIES = {
    "regression_metrics": (metric_table, with_metrics("SELECT * FROM m")),
    "leaderboard": (
        lambda s, d: metrics.leaderboard(metric_table(s, d)), with_metrics("SELECT * FROM b ORDER BY val_rmse, model")),
    "champion": (
        lambda s, d: metrics.champion(metrics.leaderboard(metric_table(s, d))),
        with_metrics("SELECT * FROM b ORDER BY val_rmse, model LIMIT 1")),
    "overfit_gap": (
        lambda s, d: metrics.overfit_gap(metric_table(s, d)),
        with_metrics("SELECT model, round(train_r2 - val_r2, 4) AS overfit_gap_r2 FROM b")),
    "comparison_long": (
        lambda s, d: metrics.comparison_long(metrics.leaderboard(metric_table(s, d))),
        with_metrics("\nUNION ALL ".join(
            f"SELECT model, '{c}' AS metric, {c} AS value FROM b" for c in metrics.LEADERBOARD_METRICS))),
    "trial_rank": (trial_rank, TRIAL_SQL),
    "train_linear": (train_linear, LINEAR_SQL),
    "search_linear": (search_linear, search_sql()),
    "train_stump": (train_stump, STUMP_SQL),
    "train_tree": (train_tree, None),
    "train_gbt": (train_gbt, None),
    "boosting_patience": (boosting_patience, None),
    "feature_importance": (feature_importance, None),
}
