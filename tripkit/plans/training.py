"""Tune, compare and choose Spark ML regressors."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml.base import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.functions.keys import row_hash, row_uniform
from tripkit.operators.metrics import (
    champion, leaderboard, overfit_gap, regression_metrics, top_importances, trial_table,
)
from tripkit.schema import SEED, TARGET

# Search budget, share of rows watched for early stopping, rounds without a better error on them
# after which boosting stops, and train rows for which another task pays off: each task of a tree level hands on the
# histograms of all its nodes, which cost more than thousands of rows.
SEARCH_DRAWS = 12
SEARCH_FOLDS = 3
EARLY_STOP_SHARE = 0.1
PATIENCE = 15
ROWS_A_TASK = 50_000


@dataclass(frozen=True)
class Whole:
    """Whole number drawn from [low, high)."""

    low: int
    high: int

    def draw(self, rng: random.Random) -> int:
        return rng.randrange(self.low, self.high)


@dataclass(frozen=True)
class Real:
    """Number drawn from [low, low + width)."""

    low: float
    width: float

    def draw(self, rng: random.Random) -> float:
        return self.low + rng.random() * self.width


@dataclass(frozen=True)
class Family:
    """An estimator and the values its parameters may take: lists or ranges."""

    estimator: Callable[[], Any]
    space: dict[str, list | Whole | Real]


def rounds_to_keep(errors: list[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """Rounds up to the best one, and whether ``patience`` rounds without a better one follow it."""
    best = 0
    for number, error in enumerate(errors):
        if error < errors[best]:
            best = number
        elif number - best >= patience:
            return best + 1, True
    return best + 1, False


def first_trees(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The ensemble of the first ``rounds`` trees."""
    gateway = SparkContext.getOrCreate()._gateway
    regression = gateway.jvm.org.apache.spark.ml.regression
    trees, weights = model._java_obj.trees(), model.treeWeights
    kept = gateway.new_array(regression.DecisionTreeRegressionModel, rounds)
    shares = gateway.new_array(gateway.jvm.double, rounds)
    for k in range(rounds):
        kept[k], shares[k] = trees[k], weights[k]
    shorter = GBTRegressionModel(regression.GBTRegressionModel(model.uid, kept, shares, model.numFeatures))
    model._copyValues(shorter)._transfer_params_to_java()
    return shorter


class PatientBoosting(GBTRegressor):
    """Boosted trees that stop once ``PATIENCE`` rounds bring no better error on the rows that
    ``validationIndicatorCol`` marks, cut at the best round.

    Spark's own stop looks one round ahead. Here ever longer ensembles are fitted on the other rows, twice as long each
    time, until their errors per round, one pass over the watched rows, hold a stop; a round's tree is the same in each, so the cost is
    at most twice that of the rounds needed. Without watched rows all ``maxIter`` rounds are kept.
    """

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        watched = F.coalesce(F.col(self.getOrDefault(self.validationIndicatorCol)), F.lit(False))
        rest, held = dataset.where(~watched), dataset.where(watched)
        judged = not held.isEmpty()
        rounds = min(self.getMaxIter(), 2 * PATIENCE) if judged else self.getMaxIter()
        while True:
            plain = self.copy({self.maxIter: rounds})
            plain.clear(plain.validationIndicatorCol)
            model = GBTRegressor._fit(plain, rest)
            if not judged:
                return model
            keep, stopped = rounds_to_keep(model.evaluateEachIteration(held, "squared"))
            if stopped or rounds == self.getMaxIter():
                return first_trees(model, keep)
            rounds = min(2 * rounds, self.getMaxIter())


# Fixed value: bins per feature of the published histogram learners.
BINS = 255


def model_families() -> dict[str, Family]:
    """Model families in comparison order; gradient boosting by an outside package only
    where that package is installed. An unlimited depth is 30 for a single tree, the deepest Spark
    allows, and 8 for boosted trees, whose published learner stops at 31 leaves."""
    common = {"featuresCol": "features", "labelCol": "label"}
    # Search ranges of the published comparison.
    families = {
        "linear_regression": Family(
            lambda: LinearRegression(solver="normal", regParam=0.0, **common),
            {"fitIntercept": [True, False]},
        ),
        "decision_tree": Family(
            lambda: DecisionTreeRegressor(seed=SEED, maxBins=BINS, **common),
            {
                "maxDepth": [30, 5, 10, 15, 20, 30],
                "minInstancesPerNode": Whole(1, 20),
                "minInfoGain": Real(0.0, 0.01),
            },
        ),
        "gradient_boosting": Family(
            lambda: PatientBoosting(seed=SEED, maxBins=BINS, validationIndicatorCol="early_stop", **common),
            {
                "maxIter": Whole(100, 400),
                "stepSize": Real(0.01, 0.19),
                "maxDepth": [8, 3, 5, 8, 12],
                "minInstancesPerNode": Whole(10, 50),
            },
        ),
    }
    try:
        from xgboost.spark import SparkXGBRegressor
    except ImportError:
        return families
    families["xgboost"] = Family(
        lambda: SparkXGBRegressor(features_col="features", label_col="label", tree_method="hist"),
        {
            "n_estimators": Whole(200, 600), "learning_rate": Real(0.01, 0.19),
            "max_depth": Whole(3, 8), "subsample": Real(0.6, 0.4),
            "colsample_bytree": Real(0.5, 0.5), "reg_alpha": Real(0.0, 1.0), "reg_lambda": Real(0.5, 2.0),
        },
    )
    return families


def random_forest_family() -> Family:
    """The family the first comparison used before it was replaced by a single tree."""
    return Family(
        lambda: RandomForestRegressor(seed=SEED, maxBins=BINS, featuresCol="features", labelCol="label"),
        {
            "numTrees": Whole(100, 300), "maxDepth": [30, 10, 20],
            "minInstancesPerNode": Whole(1, 10), "featureSubsetStrategy": ["sqrt", "0.5"],
        },
    )


def trial_count(space: dict, draws: int = SEARCH_DRAWS) -> int:
    """All combinations when every parameter is a finite list, else ``draws``; at most ``draws``."""
    if not all(isinstance(v, list) for v in space.values()):
        return draws
    return min(math.prod(len(v) for v in space.values()), draws)


def draw_params(space: dict, draws: int = SEARCH_DRAWS, seed: int = SEED) -> list[dict]:
    """Parameter settings to try, reproducible from the seed."""
    n, rng = trial_count(space, draws), random.Random(seed)
    if all(isinstance(v, list) for v in space.values()):
        grid: list[dict] = [{}]
        for name, values in space.items():
            grid = [{**g, name: v} for g in grid for v in values]
        return grid if len(grid) <= n else rng.sample(grid, n)
    return [
        {k: rng.choice(v) if isinstance(v, list) else v.draw(rng) for k, v in space.items()}
        for _ in range(n)
    ]


# --------------------------------------------------------------------- training


def assemble(
    df: DataFrame, features: list[str], label: str = TARGET, key: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """``features`` vector and ``label``, with the row key that folds are drawn from.

    Without a key column the key is a hash of the row's own values, which is the same
    under any partitioning or rerun.
    """
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")
    key = F.xxhash64(*features, label) if key is None else F.col(key)
    keyed = df.withColumn("label", F.col(label).cast("double")).withColumn("__key", key.cast("string"))
    return assembler.transform(keyed).select("features", "label", "__key", *(keep or []))


def with_folds(df: DataFrame, folds: int, seed: int = SEED) -> DataFrame:
    return df.withColumns({
        "fold": (row_hash(F.col("__key"), seed + 1) % folds).cast("int"),
        "early_stop": row_uniform(F.col("__key"), seed + 2) < EARLY_STOP_SHARE,
    })


def _with_params(estimator, params: dict):
    return estimator.copy({estimator.getParam(k): v for k, v in params.items()})


@dataclass
class Trained:
    name: str
    model: Model
    params: dict
    trials: DataFrame
    metrics: DataFrame
    train_sec: float
    test_metrics: dict = field(default_factory=dict)


def search(
    name: str,
    family: Family,
    train: DataFrame,
    draws: int = SEARCH_DRAWS,
    folds: int = SEARCH_FOLDS,
    seed: int = SEED,
    parallelism: int = 8,
) -> tuple[Model, dict, DataFrame]:
    """Cross-validated random search; the best setting is refitted on all train rows.

    Each fit is a distributed Spark ML job; ``parallelism`` of them run at a time, over no more
    tasks than ``ROWS_A_TASK`` asks for. One pass over the scored rows yields a fit's train and
    test error together.
    """
    spark = train.sparkSession
    stored = with_folds(train, folds, seed).persist()
    settings = draw_params(family.space, draws, seed)
    try:
        data = stored.coalesce(max(1, math.ceil(stored.count() / ROWS_A_TASK)))

        def one(job: tuple[int, int]) -> list[tuple]:
            trial, fold = job
            start = time.perf_counter()
            model = _with_params(family.estimator(), settings[trial]).fit(data.where(F.col("fold") != fold))
            seconds = time.perf_counter() - start
            held_out = (F.col("fold") == fold).alias("held_out")
            scored = model.transform(data).select("label", "prediction", held_out)
            rows = regression_metrics(scored, ["held_out"], digits=6).collect()
            error = {r["held_out"]: r["rmse"] for r in rows}
            return [(name, trial, str(settings[trial]), fold, error.get(True), error.get(False), seconds)]

        jobs = [(t, k) for t in range(len(settings)) for k in range(folds)]
        with ThreadPool(min(parallelism, len(jobs))) as pool:
            # one job at a time to a thread: the fits of a setting take as long as each other
            scores = [r for rows in pool.map(inheritable_thread_target(spark)(one), jobs, 1) for r in rows]
        schema = "model string, trial int, params string, fold int, rmse double, train_rmse double, fit_sec double"
        fold_scores = spark.createDataFrame(scores, schema)
        trials = trial_table(fold_scores, ["model", "trial", "params"], folds)
        extra = fold_scores.groupBy("model", "trial").agg(
            F.avg("train_rmse").alias("mean_train_score"), F.stddev_pop("train_rmse").alias("std_train_score"),
            F.avg("fit_sec").alias("mean_fit_time"), F.stddev_pop("fit_sec").alias("std_fit_time"),
        )
        trials = trials.join(extra, ["model", "trial"]).orderBy("rank_test_score", "trial")
        best = settings[trials.first()["trial"]]
        model = _with_params(family.estimator(), best).fit(data)
    finally:
        stored.unpersist()
    return model, best, trials


def split_metrics(name: str, model: Model, data: DataFrame, splits: list[str]) -> DataFrame:
    """Metrics of one model on the named splits, in one job."""
    scored = model.transform(data.where(F.col("split").isin(splits))).select("split", "label", "prediction")
    return regression_metrics(scored, ["split"]).withColumn("model", F.lit(name))


def train_one(name: str, family: Family, data: DataFrame, **budget) -> Trained:
    start = time.perf_counter()
    model, params, trials = search(name, family, data.where(F.col("split") == "train"), **budget)
    seconds = time.perf_counter() - start
    metrics = split_metrics(name, model, data, ["train", "val"])
    # a handful of rows, kept so that the comparison does not score everything again
    metrics = data.sparkSession.createDataFrame(metrics.collect(), metrics.schema)
    return Trained(name, model, params, trials, metrics, seconds)


@dataclass
class Comparison:
    results: list[Trained]
    leaderboard: DataFrame
    champion: Trained
    gaps: DataFrame


def compare(data: DataFrame, families: dict[str, Family] | None = None, **budget) -> Comparison:
    """Train every family on ``data`` (features, label, split), rank on validation, and
    score the champion, and nothing else, on test."""
    results = [train_one(n, f, data, **budget) for n, f in (families or model_families()).items()]
    metrics = results[0].metrics
    for r in results[1:]:
        metrics = metrics.unionByName(r.metrics)
    spark = data.sparkSession
    seconds = spark.createDataFrame([(r.name, round(r.train_sec, 1)) for r in results], "model string, train_sec double")
    board = leaderboard(metrics).join(F.broadcast(seconds), "model").orderBy("val_rmse", "model")
    best_name = champion(board).first()["model"]
    best = next(r for r in results if r.name == best_name)
    row = split_metrics(best.name, best.model, data, ["test"]).first()
    best.test_metrics = {f"test_{m}": row[m] for m in ("mae", "rmse", "r2")} if row else {}
    return Comparison(results, board, best, overfit_gap(metrics))


def feature_importance(model: Model, features: list[str], spark, top: int = 20) -> DataFrame | None:
    """Largest importances of a tree model as a table; None for models without them."""
    if not hasattr(model, "featureImportances"):
        return None
    return top_importances(model.featureImportances.toArray(), features, spark, top)
