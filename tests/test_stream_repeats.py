"""The quarantine of a stream, duplicates included, equals that of the batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from test_preparation import trip_table
from tripkit.operators import quality
from tripkit.streaming import jobs, repeats


def rows_of(df):
    return sorted((r["row_ord"], r["trip_id"], r["outcome"], tuple(r["reasons"])) for r in df.select("row_ord", "trip_id", "outcome", "reasons").collect())


def batch(df):
    return rows_of(quality.with_outcome(quality.flag_rows(df)))


def copies(spark, n=900):
    """Trips of which a third share one id, some have none, some repeat once and some are bad."""
    ids = F.when(F.col("row_ord") % 3 == 0, "hot").when(F.col("row_ord") % 11 == 1, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("t"), (F.col("row_ord") % (n // 2)).cast("string")))
    return trip_table(spark, n).withColumns({
        "dropoff_datetime": F.timestamp_add("MINUTE", F.lit(9), F.col("pickup_datetime")),
        "trip_id": ids, "passenger_count": F.when(F.col("row_ord") % 10 == 0, 0).otherwise(F.col("passenger_count"))})


def stream_of(spark, folder, schema):
    return jobs.stateful_session(spark, 4).readStream.schema(schema).parquet(folder)


def test_equals_batch_after_restarts_and_late_first_copies(spark, tmp_path):
    table, source, out = copies(spark), str(tmp_path / "in"), str(tmp_path / "out")
    # rows arrive in three parts, the last ones first, so that first copies come behind their repetitions
    parts = [table.where("row_ord >= 600"), table.where("row_ord < 200"), table.where("row_ord >= 200 AND row_ord < 600")]
    seen = None
    for part in parts:
        part.repartition(3).write.mode("append").parquet(source)
        repeats.append_all(stream_of(spark, source, table.schema), out)
        seen = part if seen is None else seen.unionByName(part)
        got = rows_of(repeats.read_judged(spark, out))
        assert got == batch(seen)
    assert sum("duplicate_trip_id" in r[3] for r in got) > 300
    assert {r[2] for r in got} == {"clean", "quarantine"}


def test_a_trigger_with_nothing_new_and_a_lagging_reader(spark, tmp_path):
    table, source, out = copies(spark, 60), str(tmp_path / "in"), str(tmp_path / "out")
    table.write.parquet(source)
    repeats.append_all(stream_of(spark, source, table.schema), out)
    repeats.append_all(stream_of(spark, source, table.schema), out)
    assert rows_of(repeats.read_judged(spark, out)) == batch(table)
    table.withColumn("row_ord", F.col("row_ord") + 1000).write.mode("append").parquet(source)
    repeats.append_judged(stream_of(spark, source, table.schema), out).awaitTermination()
    late = [r for r in rows_of(repeats.read_judged(spark, out)) if r[0] >= 1000]
    repeats.append_repeats(stream_of(spark, source, table.schema), out).awaitTermination()
    settled = [r for r in rows_of(repeats.read_judged(spark, out)) if r[0] >= 1000]
    assert len(late) == len(settled) == 60 and all("duplicate_trip_id" in r[3] for r in settled)


def test_an_empty_stream(spark, tmp_path):
    table, source, out = copies(spark, 10), str(tmp_path / "in"), str(tmp_path / "out")
    table.where("false").write.parquet(source)
    repeats.append_all(stream_of(spark, source, table.schema), out)
    assert rows_of(repeats.read_judged(spark, out)) == []
