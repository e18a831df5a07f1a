"""The quarantine of a stream with its duplicates, equal to that of a batch over the same rows.

Two queries read one stream. The first judges and appends rows. The second is a streaming aggregate whose state is
one row per id, the smallest input order and the number of copies; tasks add up their own rows before the shuffle,
so a hot id travels as one row per task. What it hands on are the ids that repeat, those touched by a trigger.
Readers join these few to the rows, so the first copy is the first in input order wherever and whenever it arrived,
also behind copies that were written as clean before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripkit.functions.weather import holds
from tripkit.operators.lookup import lookup_join
from tripkit.operators.quality import with_outcome
from tripkit.schema import ENFORCED, ROW_ORDER, Thresholds
from tripkit.streaming.jobs import validate, write_stream


def append_judged(stream: DataFrame, path: str, limits: Thresholds = ENFORCED) -> StreamingQuery:
    """Append every row with the ``reasons`` that it alone gives."""
    return write_stream(validate(stream, limits).drop("outcome"), f"{path}/rows")


def append_repeats(stream: DataFrame, path: str, key: str = "trip_id", order: str = ROW_ORDER) -> StreamingQuery:
    """Append the ids that a trigger has seen again, null among them, with the smallest ``order`` so far.

    ``order`` must be unique. A trigger that runs again overwrites what it wrote. The state holds one row for every id
    ever seen; its number of partitions is that of the stream's session (``jobs.stateful_session``).
    """
    ids = stream.groupBy(key).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
    folder = f"{path}/repeats"

    def store(repeats: DataFrame, trigger: int) -> None:
        repeats.write.mode("overwrite").parquet(f"{folder}/data/trigger={trigger}")

    repeated = ids.where("copies > 1").select(key, "first")
    nothing = stream.sparkSession.createDataFrame([], repeated.schema)
    nothing.write.mode("overwrite").parquet(f"{folder}/data/trigger=-1")  # readers find a table before the first trigger
    writer = repeated.writeStream.outputMode("update").foreachBatch(store).trigger(availableNow=True)
    return writer.option("checkpointLocation", f"{folder}/_state").start()


def append_all(stream: DataFrame, path: str, limits: Thresholds = ENFORCED, key: str = "trip_id", order: str = ROW_ORDER) -> None:
    """Take in what is there, rows first: a reader then knows of every copy of what was written."""
    append_judged(stream, path, limits).awaitTermination()
    append_repeats(stream, path, key, order).awaitTermination()


def read_judged(spark: SparkSession, path: str, key: str = "trip_id", order: str = ROW_ORDER) -> DataFrame:
    """All rows so far with ``reasons``, the duplicates' last, and ``outcome``, as a batch would judge them.

    A copy that the second query has not read yet counts as not repeated.
    """
    repeats = spark.read.parquet(f"{path}/repeats/data").groupBy(key).agg(F.min("first").alias("__first"))
    joined = lookup_join(spark.read.parquet(f"{path}/rows/data"), repeats, [key])
    again = holds(F.col(order) > F.col("__first"))
    reasons = F.when(again, F.array_append("reasons", F.lit("duplicate_trip_id"))).otherwise(F.col("reasons"))
    return with_outcome(joined.withColumn("reasons", reasons)).drop("__first")
