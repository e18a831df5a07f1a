"""Whole jobs: the batch run, the earlier run, and the set of exploratory tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.profiles import SHAPES
from catalogue.quality import ROUGH_BAD, RULES
from catalogue.sql import using
from tripkit.plans import end_to_end, first_generation
from tripkit.plans.score import load_scorer
from tripkit.session import shared_path
from tripkit.sources import derived, tracking, versions


def batch_run(spark, sf):
    """Ingest, judge, prepare and version all trips; read the stored split sizes back.

    Less than half of the derived trips lie inside the box, hence the lower gate.
    """
    base = shared_path(spark, "run")
    result = end_to_end.run(
        spark, base, derived.trips(spark, sf), derived.weather(spark, sf), skip_eda=True, skip_train=True,
        minimum_pass_rate=0.4)
    data = versions.load_version(spark, base, result.version)["data"]
    return data.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "quarantine_rows", F.lit(result.report["quarantine_rows"]).cast("bigint"))


def whole_run(spark, sf):
    """The batch run with profile, the published search over all families, champion and registry; facts read back from its files."""
    base = shared_path(spark, "run")
    result = end_to_end.run(
        spark, base, derived.trips(spark, sf), derived.weather(spark, sf), minimum_pass_rate=0.4)
    run, best = result.run_id, result.comparison.champion
    stored = spark.read.json(f"{base}/validation_reports/run={run}").first()
    names = [r.name for r in result.comparison.results]
    trials = {n: spark.read.csv(f"{base}/trials/run={run}/{n}", header=True) for n in names}
    scorer = load_scorer(spark, base)
    identity = scorer.identity(spark).first()
    metadata = versions.load_version(spark, base, result.version)["metadata"]
    board = [r["val_rmse"] for r in result.comparison.leaderboard.collect()]
    lowest = min(r.metrics.where("split = 'val'").first()["rmse"] for r in result.comparison.results)
    logged = {(r["stage"], r["key"]): r["value"] for r in tracking.read_metrics(spark, base).collect()}
    profiled = [n for n in SHAPES if spark.read.json(f"{base}/profile/run={run}/{n}").columns]
    facts = {
        **{c: stored[c] for c in ("total_rows", "clean_rows", "quarantine_rows")},
        **{f"n_{s}": n for s, n in result.split_sizes.items()},
        **{f"trials_{n}": t.count() for n, t in trials.items()},
        **{f"best_rank_{n}": t.agg(F.min(F.col("rank_test_score").cast("int"))).first()[0] for n, t in trials.items()},
        "profile_tables": len(profiled), "profile_failures": len(result.profile_failures),
        "leaderboard_rises": board == sorted(board), "champion_is_lowest": board[0] == lowest,
        "champion_tested": len(best.test_metrics), "features": len(identity["features"]),
        "names_as_stored": identity["features"] == metadata["numeric_features"] + metadata["categorical_features"],
        "identity_is_registered": (identity["model_version"], identity["dataset_version"]) == (str(result.model_version), result.version),
        "clean_rows_logged": float(logged["ingestion", "clean_rows"]), "splits_logged": float(logged["preprocessing", "train"]),
        "importances": spark.read.json(f"{base}/importance/run={run}/decision_tree").count(),
    }
    return spark.createDataFrame([(k, float(v)) for k, v in facts.items()], "fact string, value double")


def first_generation_run(spark, sf):
    """The earlier job on all trips; the manifest rows of its two snapshots."""
    base = shared_path(spark, "first-generation")
    first_generation.run(derived.trips(spark, sf), base, "orders")
    return versions.read_snapshots(spark, base).select(
        "source_description", "n_rows", "n_columns",
        F.col("validation_report")["total_rows_dropped"].cast("bigint").alias("total_rows_dropped"))


QUERIES = {
    "batch_run": (batch_run, using("flagged", f"""
        WITH n AS (SELECT count(*) AS n, CAST(ceil(cast(0.2 as double) * count(*)) AS BIGINT) AS n_test FROM clean),
        v AS (SELECT n, n_test, CAST(ceil(cast(0.125 as double) * (n - n_test)) AS BIGINT) AS n_val,
                     (SELECT count(*) FROM flagged WHERE {' OR '.join(RULES)}) AS quarantine_rows FROM n)
        SELECT 'test' AS split, n_test AS n_rows, quarantine_rows FROM v
        UNION ALL SELECT 'val', n_val, quarantine_rows FROM v
        UNION ALL SELECT 'train', n - n_test - n_val, quarantine_rows FROM v""")),
    "first_generation_run": (first_generation_run, using("trips", f"""
        WITH c AS (SELECT count(*) FILTER (NOT {ROUGH_BAD}) AS n, count(*) FILTER ({ROUGH_BAD}) AS dropped FROM trips),
        s AS (SELECT n, dropped, CAST(ceil(cast(0.2 as double) * n) AS BIGINT) AS n_test FROM c)
        SELECT 'orders_train_split' AS source_description, n - n_test AS n_rows, CAST(23 AS INTEGER) AS n_columns,
               dropped AS total_rows_dropped FROM s
        UNION ALL SELECT 'orders_test_split', n_test, CAST(23 AS INTEGER), dropped FROM s""")),
    "whole_run": (whole_run, using("flagged", f"""
        WITH n AS (SELECT count(*) AS n, CAST(ceil(cast(0.2 as double) * count(*)) AS BIGINT) AS n_test FROM clean),
        v AS (SELECT n, n_test, CAST(ceil(cast(0.125 as double) * (n - n_test)) AS BIGINT) AS n_val FROM n)
        SELECT 'total_rows' AS fact, CAST((SELECT count(*) FROM flagged) AS DOUBLE) AS value
        UNION ALL SELECT 'quarantine_rows', (SELECT count(*) FROM flagged WHERE {' OR '.join(RULES)})
        UNION ALL SELECT unnest(['clean_rows', 'clean_rows_logged']), n FROM v
        UNION ALL SELECT 'n_test', n_test FROM v UNION ALL SELECT 'n_val', n_val FROM v
        UNION ALL SELECT unnest(['n_train', 'splits_logged']), n - n_test - n_val FROM v
        UNION ALL SELECT 'trials_linear_regression', 2
        UNION ALL SELECT 'trials_' || unnest(['decision_tree', 'gradient_boosting']), 12
        UNION ALL SELECT 'best_rank_' || unnest(['linear_regression', 'decision_tree', 'gradient_boosting']), 1
        UNION ALL SELECT unnest(['leaderboard_rises', 'champion_is_lowest', 'names_as_stored', 'identity_is_registered']), 1
        UNION ALL SELECT 'profile_tables', 19 UNION ALL SELECT 'profile_failures', 0
        UNION ALL SELECT 'champion_tested', 3 UNION ALL SELECT 'features', 34 UNION ALL SELECT 'importances', 20""")),
}
