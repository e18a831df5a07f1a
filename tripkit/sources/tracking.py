"""Append-only run metrics and model stage events."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.sources.versions import utc_now

METRIC_SCHEMA = "run_id string, parent_run_id string, stage string, key string, value string, ts string"
STAGE_SCHEMA = "event_ord bigint, model string, version int, stage string, dataset_version string"
PRODUCTION, ARCHIVED = "Production", "Archived"


def log_metrics(
    spark: SparkSession, base: str, run_id: str, stage: str, values: dict, parent: str | None = None
) -> None:
    now = utc_now().isoformat()
    rows = [(run_id, parent, stage, k, None if v is None else str(v), now) for k, v in values.items()]
    spark.createDataFrame(rows, METRIC_SCHEMA).coalesce(1).write.mode("append").json(f"{base}/run_metrics")


def read_metrics(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(METRIC_SCHEMA).json(f"{base}/run_metrics")


def report_metrics(report: DataFrame, prefix: str = "ingestion") -> DataFrame:
    """A one-row report as (key, value) metric rows, every counter included."""
    numbers = [c for c, t in report.dtypes if t in ("bigint", "int", "double")]
    return report.select(
        F.inline(F.array(*[
            F.struct(F.lit(f"{prefix}.{c}").alias("key"), F.col(c).cast("double").alias("value")) for c in numbers
        ]))
    )


def current_stages(events: DataFrame) -> DataFrame:
    """Stage of every model version after its last event."""
    last = F.max_by(F.struct("stage", "dataset_version"), "event_ord")
    return events.groupBy("model", "version").agg(last.alias("s")).select("model", "version", "s.*")


def production_version(events: DataFrame) -> DataFrame:
    """Newest version per model that is in production, with the dataset it was trained on."""
    newest = F.max_by(F.struct("version", "dataset_version"), "version")
    return (
        current_stages(events).where(F.col("stage") == PRODUCTION)
        .groupBy("model").agg(newest.alias("v")).select("model", "v.*")
    )


def promotion_events(
    events: DataFrame, model: str, version: int, dataset_version: str
) -> DataFrame:
    """Event rows that archive what is in production and promote ``version``."""
    spark = events.sparkSession
    last = events.agg(F.coalesce(F.max("event_ord"), F.lit(0)).alias("n")).first()["n"]
    archived = (
        current_stages(events)
        .where((F.col("model") == model) & (F.col("stage") == PRODUCTION) & (F.col("version") != version))
        .select(
            F.lit(last + 1).cast("bigint").alias("event_ord"), "model", "version",
            F.lit(ARCHIVED).alias("stage"), "dataset_version",
        )
    )
    promoted = spark.createDataFrame([(last + 2, model, version, PRODUCTION, dataset_version)], STAGE_SCHEMA)
    return archived.unionByName(promoted)


def read_stages(spark: SparkSession, base: str) -> DataFrame:
    try:
        return spark.read.schema(STAGE_SCHEMA).json(f"{base}/stages")
    except AnalysisException:
        return spark.createDataFrame([], STAGE_SCHEMA)


def append_stages(events: DataFrame, base: str) -> None:
    events.coalesce(1).write.mode("append").json(f"{base}/stages")


def next_model_version(events: DataFrame, model: str) -> int:
    row = events.where(F.col("model") == model).agg(F.coalesce(F.max("version"), F.lit(0)).alias("n")).first()
    return row["n"] + 1


