"""Error statistics per window of a stream, kept as partial sums that add up.

A window of a watermarked aggregation comes out only once the watermark has passed it, so the last ones
of a stream never do. Here every task appends the sums of the rows it joined (known errors, their total,
their absolute and squared totals) per window, without state of its own, and readers add them up: each
window is there as soon as its first row is, and grows with each trigger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripkit.operators.monitoring import baseline_bin, population_stability, profile_ranges
from tripkit.streaming.jobs import deduplicate, write_stream

SUMS = ["n_rows", "total", "absolute", "squares"]


def _window_sums():
    """Function for ``mapInArrow``: one row of sums per window and batch of rows. It is built here, so that it
    travels to the workers by value and they need nothing but numpy and pyarrow."""
    names = ["window_start", *SUMS]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            start, error = batch.columns
            held = start.cast(pa.int64()).to_numpy(zero_copy_only=False)
            windows, owner = np.unique(held, return_inverse=True)
            values = error.to_numpy(zero_copy_only=False).astype(float)
            known = ~np.isnan(values)
            values = np.where(known, values, 0.0)
            totals = [np.bincount(owner, x, len(windows)) for x in (known, values, np.abs(values), values * values)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows).cast(start.type), pa.array(totals[0].astype(np.int64)), *(pa.array(t) for t in totals[1:])], names=names)

    return sums


def window_sums(joined: DataFrame, at: str, label: str, prediction: str, width: str = "1 day") -> DataFrame:
    """Partial sums of the errors per tumbling window; works on a batch and on a stream.

    A row without a prediction or a label belongs to its window and adds nothing; one without a time to none.
    """
    error = (F.col(prediction) - F.col(label)).cast("double")
    known = joined.where(F.col(at).isNotNull()).select(F.window(at, width)["start"].alias("window_start"), error.alias("error"))
    kind = known.schema["window_start"].dataType.simpleString()
    return known.mapInArrow(_window_sums(), f"window_start {kind}, n_rows bigint, total double, absolute double, squares double")


def merged_windows(sums: DataFrame, digits: int = 4) -> DataFrame:
    """(window_start, n_rows, mae, rmse, bias) of partial sums, as ``accuracy_by_window`` has them."""
    merged = sums.groupBy("window_start").agg(*(F.sum(c).alias(c) for c in SUMS))
    means = {"mae": F.try_divide("absolute", "n_rows"), "rmse": F.sqrt(F.try_divide("squares", "n_rows")), "bias": F.try_divide("total", "n_rows")}
    return merged.select("window_start", "n_rows", *(F.round(m, digits).alias(name) for name, m in means.items()))


def monitor_windows(predictions: DataFrame, actuals: DataFrame, key: str, at: str, path: str, delay: str = "1 hour",
                    horizon: str = "1 day", width: str = "1 day") -> StreamingQuery:
    """Append the sums of a stream of predictions joined to a stream of actuals below ``path``.

    ``predictions`` has (key, ``at``, prediction); ``actuals`` has (key, ``actual_at``, label). An actual counts if it
    arrives at or within ``horizon`` after its prediction, which bounds the state of both sides; one without a time
    is not known yet. Rows of an inner join come out in the trigger that completes them. ``read_windows`` reads them.
    """
    p = predictions.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).alias("p")
    a = deduplicate(actuals.where(F.col("actual_at").isNotNull()), key, "actual_at", delay).alias("a")
    span = F.expr(f"a.actual_at >= p.{at} AND a.actual_at <= p.{at} + INTERVAL {horizon}")
    joined = p.join(a, (F.col(f"p.{key}") == F.col(f"a.{key}")) & span).select(F.col(f"p.{at}").alias(at), "p.prediction", "a.label")
    return write_stream(window_sums(joined, at, "label", "prediction", width), path)


def read_windows(spark, path: str, digits: int = 4) -> DataFrame:
    """All windows so far, the last ones too."""
    return merged_windows(spark.read.parquet(f"{path}/data"), digits)


def _bin_counts(columns: list[str], bins: int):
    """Function for ``mapInArrow``: rows per window, column and bin of a batch; built here for the same reason."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, *found = batch.columns
            windows, owner = np.unique(start.cast(pa.int64()).to_numpy(zero_copy_only=False), return_inverse=True)
            for name, column in zip(columns, found, strict=True):
                known = np.flatnonzero(np.asarray(column.is_valid()))
                cells = owner[known] * bins + column.drop_null().to_numpy(zero_copy_only=False)
                n = np.bincount(cells, minlength=len(windows) * bins)
                held = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(windows[held // bins]).cast(start.type), pa.array([name] * len(held), pa.string()),
                     pa.array((held % bins).astype(np.int32)), pa.array(n[held].astype(np.int64))],
                    names=["window_start", "column", "bin", "n_rows"])

    return counts


def window_bins(table: DataFrame, profile: DataFrame, at: str, width: str = "1 day") -> DataFrame:
    """Partial counts (window_start, column, bin, n_rows) over the bins of a stored profile; a batch or a stream.

    Unknown values belong to no bin, a row without a time to no window.
    """
    ranges, bins = profile_ranges(profile)
    start = F.window(F.col(at).cast("timestamp"), width)["start"].alias("window_start")
    placed = table.where(F.col(at).isNotNull()).select(start, *(baseline_bin(c, ends, bins).alias(f"bin_{k}") for k, (c, ends) in enumerate(ranges.items())))
    return placed.mapInArrow(_bin_counts(list(ranges), bins), "window_start timestamp, column string, bin int, n_rows bigint")


def monitor_drift(stream: DataFrame, profile: DataFrame, at: str, path: str, width: str = "1 day") -> StreamingQuery:
    """Append the counts of a stream below ``path``; each trigger reads its own rows and the few of the profile."""
    return write_stream(window_bins(stream, profile, at, width), path)


def read_drift(spark, path: str, profile: DataFrame) -> DataFrame:
    """(window_start, column, psi) of all windows so far."""
    return population_stability(profile, spark.read.parquet(f"{path}/data"), ["window_start"])
