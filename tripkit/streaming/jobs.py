"""Row rules, deduplication, scoring and monitoring on unbounded input.

All jobs write files below a shared folder with a checkpoint, so a restarted query goes
on where it stopped. The triggers default to "all available, then stop".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripkit.operators.monitoring import accuracy_by_window
from tripkit.operators.quality import reasons_of, row_rules, with_outcome
from tripkit.schema import ENFORCED, ROW_ORDER, Thresholds

SALTS = 32


def stateful_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session for stateful jobs with ``partitions`` state partitions.

    Every state partition costs a store and a commit per trigger, and the number is fixed for
    the life of a query's checkpoint: choose it for the largest cluster the query shall use.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session


def read_table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Files ``name`` below ``folder`` as a stream, with the schema of what is there now."""
    schema = spark.read.parquet(f"{folder}/{name}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def write_stream(stream: DataFrame, path: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Append to exactly-once parquet files; the checkpoint lies beside the data."""
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("checkpointLocation", f"{path}/_state").start(f"{path}/data")


def validate(stream: DataFrame, limits: Thresholds = ENFORCED) -> DataFrame:
    """Add ``reasons`` and ``outcome`` by the rules that judge one row at a time."""
    return with_outcome(stream.withColumn("reasons", reasons_of(row_rules(limits))))


def route(stream: DataFrame, path: str, limits: Thresholds = ENFORCED) -> StreamingQuery:
    """Judge a stream and write clean and quarantined rows to separate partitions."""
    return write_stream(validate(stream, limits), path, ["outcome"])


def deduplicate(
    stream: DataFrame, key: str, at: str, delay: str = "1 hour", order: str = ROW_ORDER
) -> DataFrame:
    """One row of each key, from the first trigger that has one; state is dropped once the watermark
    has passed it. Which of the copies within a trigger stays is not defined.

    Two steps keep a hot key from meeting in one task: copies are first removed per
    (key, salt), so at most ``SALTS`` rows of a key reach the second step. The salt comes
    from the unique ``order``, so even identical copies spread, and a rerun repeats it.
    """
    salted = stream.withColumns({
        at: F.col(at).cast("timestamp"),  # watermarks need a zoned time
        "__salt": F.pmod(F.xxhash64(order), F.lit(SALTS)),
    })
    per_salt = salted.withWatermark(at, delay).dropDuplicatesWithinWatermark([key, "__salt"])
    return per_salt.drop("__salt").dropDuplicatesWithinWatermark([key])


def score(stream: DataFrame, scorer, weather: DataFrame | None = None) -> DataFrame:
    """Score a stream of trips; weather is a static table joined by pickup date."""
    from tripkit.operators.enrich import carried_columns, join_weather, weather_fill

    if weather is not None:
        own = [c for c in carried_columns(weather) if c in stream.columns]
        joined = join_weather(stream.drop(*own), weather).drop("weather_matched")
        stream = joined.fillna(scorer.prep.weather_fill or weather_fill(weather))
    return scorer.predict(stream)


def monitor(
    predictions: DataFrame, actuals: DataFrame, key: str, at: str, delay: str = "1 hour",
    horizon: str = "1 day", width: str = "1 day",
) -> DataFrame:
    """Error statistics per window of a stream of predictions joined to a stream of actuals.

    ``predictions`` has (key, ``at``, prediction); ``actuals`` has (key, ``actual_at``,
    label). An actual must arrive within ``horizon`` after its prediction, which bounds the
    state of both sides.
    """
    p = predictions.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).alias("p")
    a = deduplicate(actuals, key, "actual_at", delay).alias("a")
    span = F.expr(f"a.actual_at >= p.{at} AND a.actual_at <= p.{at} + INTERVAL {horizon}")
    joined = p.join(a, (F.col(f"p.{key}") == F.col(f"a.{key}")) & span).select(
        F.col(f"p.{at}").alias(at), "p.prediction", "a.label"
    )
    return accuracy_by_window(joined, at, "label", "prediction", width, digits=6)
