"""The whole batch job: ingest, validate, profile, prepare, train, register."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.operators import quality
from tripkit.operators.enrich import enrich, weather_fill
from tripkit.plans.prepare import prepare_and_version
from tripkit.plans.profile import profile, write_profile
from tripkit.plans.score import register
from tripkit.plans.training import assemble, compare, feature_importance
from tripkit.schema import ENFORCED, MIN_PASS_RATE, ROW_ORDER, Thresholds
from tripkit.session import materialize
from tripkit.sources import readers
from tripkit.sources.tracking import log_metrics
from tripkit.sources.versions import load_version


@dataclass
class RunResult:
    run_id: str
    report: dict
    version: str | None = None
    split_sizes: dict = field(default_factory=dict)
    profile_failures: dict = field(default_factory=dict)
    comparison: Any = None
    model_version: int | None = None
    elapsed_sec: float = 0.0


def ingest(
    trips: DataFrame, weather: DataFrame | None, base: str, run_id: str, limits: Thresholds = ENFORCED,
    minimum: float = MIN_PASS_RATE,
) -> tuple[DataFrame, DataFrame, dict]:
    """Enrich and judge every row; write clean and quarantine tables and the report.

    The judged rows are written once, partitioned by outcome, and all later stages read
    that table back, so nothing upstream is computed twice.
    """
    spark = trips.sparkSession
    quality.require_columns(trips)
    trips = quality.nan_as_null(trips)
    flagged = enrich(quality.flag_rows(trips, limits), weather)
    path = f"{base}/ingested/run={run_id}"
    quality.with_outcome(flagged).write.partitionBy("outcome").mode("errorifexists").parquet(path)
    judged = spark.read.parquet(path)
    once = quality.validation_report(judged)
    report = spark.createDataFrame([once.first()], once.schema)
    report.write.mode("errorifexists").json(f"{base}/validation_reports/run={run_id}")
    row = report.first().asDict()
    quality.require_pass_rate(report, minimum)
    clean = judged.where(F.col("outcome") == "clean").drop("outcome", "reasons")
    quarantine = judged.where(F.col("outcome") == "quarantine").drop("outcome")
    return clean, quarantine, row


def run(
    spark: SparkSession,
    base: str,
    trips: DataFrame | str | list[str],
    weather: DataFrame | str | None = None,
    scaler: str = "standard",
    encoder: str = "ordinal",
    skip_eda: bool = False,
    skip_train: bool = False,
    split_mode: str = "exact",
    minimum_pass_rate: float = MIN_PASS_RATE,
    families: dict | None = None,
    **budget,
) -> RunResult:
    """Run all stages; every stage reads what the one before it wrote below ``base``."""
    start, run_id = time.perf_counter(), uuid.uuid4().hex[:12]
    if not isinstance(trips, DataFrame):
        trips = readers.read_trips(spark, *([trips] if isinstance(trips, str) else trips))
    if not isinstance(weather, DataFrame):
        weather = readers.read_weather(spark, weather)
    weather = materialize(weather)
    clean, _, report = ingest(trips, weather, base, run_id, minimum=minimum_pass_rate)
    result = RunResult(run_id, report)
    log_metrics(spark, base, run_id, "ingestion", {k: v for k, v in report.items() if k != "schema_errors"})

    if not skip_eda:
        tables, result.profile_failures = profile(clean.drop(ROW_ORDER))
        result.profile_failures |= write_profile(tables, f"{base}/profile/run={run_id}")
        if "target_shape" not in result.profile_failures:
            shape = spark.read.json(f"{base}/profile/run={run_id}/target_shape").first().asDict()
            log_metrics(spark, base, run_id, "eda", {
                "target_skewness": shape.get("skewness"), "target_kurtosis": shape.get("kurtosis"),
            })

    fill = {} if weather.isEmpty() else weather_fill(weather)
    result.version, fitted = prepare_and_version(clean, base, encoder, scaler, split_mode, fill)
    stored = load_version(spark, base, result.version)
    meta = stored["metadata"]
    result.split_sizes = {s: meta[f"n_{s}"] for s in ("train", "val", "test")}
    log_metrics(spark, base, run_id, "preprocessing", {
        "version": result.version, "content_hash": meta["content_hash"], "scaler": scaler, "encoder": encoder,
        "n_features": len(fitted.feature_names), **result.split_sizes,
    })

    if not skip_train:
        data = assemble(stored["data"], fitted.feature_names, keep=["split"])
        result.comparison = compare(data, families, **budget)
        best = result.comparison.champion
        result.model_version = register(best.model, base, spark, result.version)
        for trained in result.comparison.results:
            trained.trials.coalesce(1).write.mode("errorifexists").csv(
                f"{base}/trials/run={run_id}/{trained.name}", header=True
            )
            importance = feature_importance(trained.model, fitted.feature_names, spark)
            if importance is not None:
                importance.coalesce(1).write.mode("errorifexists").json(
                    f"{base}/importance/run={run_id}/{trained.name}"
                )
        log_metrics(spark, base, run_id, "champion", {
            "model": best.name, "registry_version": result.model_version, **best.test_metrics,
        })
    result.elapsed_sec = round(time.perf_counter() - start, 2)
    log_metrics(spark, base, run_id, "run", {"elapsed_sec": result.elapsed_sec})
    return result
