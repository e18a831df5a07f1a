"""Regression metrics, trial ranks, leaderboard and champion, over plain tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Metric names shown on the leaderboard, and the one that decides.
LEADERBOARD_METRICS = ["val_rmse", "val_mae", "val_r2"]
CHAMPION_METRIC = "val_rmse"


def regression_metrics(
    predictions: DataFrame, by: Sequence[str], label: str = "label", prediction: str = "prediction",
    digits: int = 4,
) -> DataFrame:
    """MAE, RMSE and R2 per group; R2 is null when the label is constant."""
    error = F.col(label) - F.col(prediction)
    n = F.count(F.lit(1))
    residual = F.sum(error * error)
    explained = F.lit(1.0) - F.try_divide(residual, F.var_pop(label) * n)
    return (
        predictions.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
        .groupBy(*by)
        .agg(
            n.alias("n_rows"),
            F.round(F.avg(F.abs(error)), digits).alias("mae"),
            F.round(F.sqrt(F.avg(error * error)), digits).alias("rmse"),
            F.round(explained, digits).alias("r2"),
        )
    )


def overfit_gap(metrics: DataFrame, by: str = "model") -> DataFrame:
    """Train R2 minus validation R2."""
    r2 = {s: F.max(F.when(F.col("split") == s, F.col("r2"))) for s in ("train", "val")}
    return metrics.groupBy(by).agg(F.round(r2["train"] - r2["val"], 4).alias("overfit_gap_r2"))


def leaderboard(metrics: DataFrame) -> DataFrame:
    """One row per model, best validation RMSE first."""

    def of(split: str, metric: str):
        return F.max(F.when(F.col("split") == split, F.col(metric)))

    return (
        metrics.groupBy("model")
        .agg(
            of("val", "mae").alias("val_mae"), of("val", "rmse").alias("val_rmse"),
            of("val", "r2").alias("val_r2"), of("train", "r2").alias("train_r2"),
        )
        .orderBy("val_rmse", "model")
    )


def champion(board: DataFrame, metric: str = CHAMPION_METRIC) -> DataFrame:
    """The leaderboard row with the smallest metric, first name on ties."""
    best = F.min_by(F.struct(*board.columns), F.struct(F.col(metric), F.col("model")))
    return board.where(F.col(metric).isNotNull()).agg(best.alias("best")).select("best.*")


def comparison_long(board: DataFrame, metrics: Sequence[str] = tuple(LEADERBOARD_METRICS)) -> DataFrame:
    return board.unpivot("model", list(metrics), "metric", "value")


def trial_table(fold_scores: DataFrame, by: Sequence[str], folds: int) -> DataFrame:
    """Per-fold scores (rmse, lower is better) to one ranked row per trial.

    ``fold_scores`` has the trial columns, ``fold`` and ``rmse``. The mean is over folds,
    not pooled; the deviation is the population one; ties share the smaller rank. The
    first trial column is the model family, ranks are within it.
    """
    per_fold = [
        F.max(F.when(F.col("fold") == k, F.col("rmse"))).alias(f"split{k}_test_score") for k in range(folds)
    ]
    trials = fold_scores.groupBy(*by).agg(
        *per_fold, F.avg("rmse").alias("mean_test_score"), F.stddev_pop("rmse").alias("std_test_score")
    )
    # rounded so that the last bits of a mean cannot decide a tie
    ranked = F.rank().over(Window.partitionBy(by[0]).orderBy(F.round("mean_test_score", 6)))
    return trials.withColumn("rank_test_score", ranked)


def top_importances(importances: Sequence[float], names: Sequence[str], spark, top: int = 20) -> DataFrame:
    """The features a tree model leaned on most, largest first."""
    rows = [(n, float(v)) for n, v in zip(names, importances)]
    return (
        spark.createDataFrame(rows, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature").limit(top)
    )
