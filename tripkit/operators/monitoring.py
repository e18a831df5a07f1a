"""Predictions against later actuals: accuracy per window, retraining, input drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.functions.weather import holds
from tripkit.operators.enrich import first_per_key
from tripkit.operators.stats import bin_number, histogram, value_ranges

PSI_FLOOR = 1e-4
PSI_BINS = 10


def join_actuals(
    predictions: DataFrame, actuals: DataFrame, key: str = "trip_id", order: str = "row_ord"
) -> DataFrame:
    """Inner join on the key. Actuals are reduced to their first row per key before the
    join, so repeated keys cannot multiply rows. Both sides grow with the data, so nothing
    is broadcast by hint: the reduced side is already partitioned by the key, and adaptive
    execution splits the partition of a key that is hot among the predictions."""
    return predictions.join(first_per_key(actuals, [key], order).drop(order), key)


def window_metrics(error: Column) -> dict[str, Column]:
    return {
        "n_rows": F.count(error),
        "mae": F.avg(F.abs(error)),
        "rmse": F.sqrt(F.avg(error * error)),
        "bias": F.avg(error),
    }


def accuracy_by_window(
    joined: DataFrame, at: str, label: str, prediction: str, width: str = "1 day", digits: int = 4
) -> DataFrame:
    """Error statistics per tumbling window; works on a batch and on a watermarked stream."""
    error = F.col(prediction) - F.col(label)
    return (
        joined.groupBy(F.window(at, width).alias("w"))
        .agg(*[m.alias(n) for n, m in window_metrics(error).items()])
        .select(
            F.col("w.start").alias("window_start"), "n_rows",
            *[F.round(c, digits).alias(c) for c in ("mae", "rmse", "bias")],
        )
    )


def retrain_signal(windows: DataFrame, champion_rmse: float, factor: float = 1.2) -> DataFrame:
    """Windows with a flag that says whether their error calls for retraining; one without a known error does not."""
    return windows.withColumn("retrain", holds(F.col("rmse") > F.lit(champion_rmse * factor)))


def baseline_profile(baseline: DataFrame, columns: Sequence[str], bins: int = PSI_BINS) -> DataFrame:
    """(column, bin, low, high, n_rows): equal-width bins of each column between its ends, empty ones too.

    What later data are compared with; a few rows, to be stored with the data. A column without any
    known value has no row.
    """
    return _profile(baseline, columns, bins)[0]


def _profile(baseline: DataFrame, columns: Sequence[str], bins: int) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    ranges = {c: r for c, r in value_ranges(baseline, columns).items() if r}
    rows = [(c, b, *ends) for c, ends in ranges.items() for b in range(bins)]
    grid = baseline.sparkSession.createDataFrame(rows, "column string, bin int, low double, high double")
    counted = histogram(baseline, list(ranges), bins, ranges).select("column", "bin", "n_rows")
    return grid.join(counted, ["column", "bin"], "left").fillna(0, ["n_rows"]), ranges


def profile_ranges(profile: DataFrame) -> tuple[dict[str, tuple[float, float]], int]:
    """Ends of each column of a stored profile, and its number of bins."""
    rows = profile.groupBy("column").agg(F.first("low").alias("low"), F.first("high").alias("high"), F.count(F.lit(1)).alias("bins")).collect()
    return {r["column"]: (r["low"], r["high"]) for r in rows}, max((r["bins"] for r in rows), default=0)


def baseline_bin(column: str, ends: tuple[float, float], bins: int) -> Column:
    """Bin of the baseline; values beyond its ends belong to the end bins, unknown ones to none."""
    value = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    low, high = (F.lit(e) for e in ends)
    return F.when(value.isNotNull(), bin_number(F.least(F.greatest(value, low), high), low, high, bins))


def population_stability(profile: DataFrame, counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Population stability index per column, and per ``by``, of counts (by, column, bin, n_rows) against a profile.

    Counts of the same bin add up. An empty bin counts as a small share, so the index stays finite. Without
    ``by`` a column without counts is compared as empty; with it, it has no row.
    """
    floor = F.lit(PSI_FLOOR)
    expected = profile.groupBy("column").agg(F.sort_array(F.collect_list(F.struct("bin", "n_rows"))).alias("expected"), F.sum("n_rows").alias("n_expected"))
    seen = (counts.groupBy(*by, "column", "bin").agg(F.sum("n_rows").alias("n_rows")).groupBy(*by, "column")
            .agg(F.map_from_entries(F.collect_list(F.struct("bin", "n_rows"))).alias("seen"), F.sum("n_rows").alias("n_seen")))

    def term(cell: Column) -> Column:
        p = F.greatest(cell["n_rows"] / F.col("n_expected"), floor)
        q = F.greatest(F.coalesce(F.try_element_at("seen", cell["bin"]) / F.col("n_seen"), floor), floor)
        return (q - p) * F.log(q / p)

    psi = F.aggregate(F.transform("expected", term), F.lit(0.0), lambda total, x: total + x)
    return expected.join(seen, "column", "inner" if by else "left").select(*by, "column", F.round(psi, 6).alias("psi"))


def drift_from(profile: DataFrame, current: DataFrame) -> DataFrame:
    """Drift of ``current`` against a stored profile; the baseline itself is not read."""
    return _drift(profile, current, *profile_ranges(profile))


def _drift(profile: DataFrame, current: DataFrame, ranges: dict[str, tuple[float, float]], bins: int) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("column"), baseline_bin(c, ends, bins).alias("bin"), F.lit(1).alias("n_rows")) for c, ends in ranges.items()]
    if not cells:
        return current.sparkSession.createDataFrame([], "column string, psi double")
    return population_stability(profile, current.select(F.inline(F.array(*cells))).where(F.col("bin").isNotNull()))


def drift(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = PSI_BINS
) -> DataFrame:
    """Population stability index per column over the baseline's equal-width bins.

    Values beyond the baseline range count in the end bins, unknown values in none; an empty bin counts
    as a small share, so the index stays finite.
    """
    profile, ranges = _profile(baseline, columns, bins)
    return _drift(profile, current, ranges, bins)
