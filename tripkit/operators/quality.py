"""Row rules, the clean / quarantine split and the validation report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkit.functions.weather import holds
from tripkit.operators.lookup import lookup_join
from tripkit.schema import COORDINATES, ENFORCED, MIN_PASS_RATE, REQUIRED_COLUMNS, ROW_ORDER, Thresholds
from tripkit.session import materialize

RULE_COUNTERS = {
    "missing_gps": "missing_gps_rows",
    "invalid_timestamp": "invalid_timestamp_rows",
    "out_of_range": "out_of_range_rows",
    "invalid_eta": "negative_eta_rows",
    "invalid_passengers": "invalid_passenger_rows",
    "duplicate_trip_id": "duplicate_trip_ids",
}


class ValidationFailed(RuntimeError):
    """Too few rows passed, or required columns are absent."""


def schema_errors(df: DataFrame, required: list[str] = REQUIRED_COLUMNS) -> list[str]:
    return [f"missing required column: {c}" for c in required if c not in df.columns]


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN is a missing value, as it is in CSV input."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in numbers})


def missing_gps() -> Column:
    """Any coordinate null or NaN."""
    return reduce(Column.__or__, [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).isNull() for c in COORDINATES])


def invalid_timestamp() -> Column:
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return pickup.isNull() | dropoff.isNull() | holds(dropoff <= pickup)


def out_of_range(limits: Thresholds) -> Column:
    """Any coordinate outside the box; a missing one cannot be inside."""
    inside = [
        F.col(c).between(*(limits.lat if c.endswith("lat") else limits.lon)) for c in COORDINATES
    ]
    return ~holds(reduce(Column.__and__, inside))


def invalid_eta(limits: Thresholds) -> Column:
    eta = F.col("eta_minutes")
    valid = eta > 0
    if limits.min_eta is not None:
        valid = valid & (eta >= limits.min_eta)
    if limits.max_eta is not None:
        valid = valid & (eta <= limits.max_eta)
    return ~holds(valid)


def invalid_duration(limits: Thresholds) -> Column:
    return ~holds(F.col("trip_duration_sec").between(limits.min_duration_sec, limits.max_duration_sec))


def invalid_passengers(limits: Thresholds) -> Column:
    valid = F.col("passenger_count") > 0
    if limits.max_passengers is not None:
        valid = valid & (F.col("passenger_count") <= limits.max_passengers)
    return ~holds(valid)


def row_rules(limits: Thresholds = ENFORCED) -> dict[str, Column]:
    """The rules a single row can be judged by (true means bad); they run on streams too."""
    return {
        "missing_gps": missing_gps(),
        "invalid_timestamp": invalid_timestamp(),
        "out_of_range": out_of_range(limits),
        "invalid_eta": invalid_eta(limits),
        "invalid_passengers": invalid_passengers(limits),
    }


def reasons_of(rules: dict[str, Column]) -> Column:
    """Names of the rules a row fails, in rule order."""
    names = F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    # array_except drops the nulls inside generated code, where a filter lambda would not run
    return F.array_except(names, F.array(F.lit(None).cast("string")))


def mark_duplicates(
    df: DataFrame, key: str = "trip_id", order: str = ROW_ORDER, flag: str = "is_duplicate"
) -> DataFrame:
    """Flag every copy of a key but the first in input order; null keys equal each other.

    ``order`` must be unique. Copies are counted by a pre-aggregated group-by over the
    two narrow columns, and only keys that really repeat are joined back, so neither a
    hot key nor the null key gathers its rows in one task.
    """
    repeated = (
        df.groupBy(key)
        .agg(F.min(order).alias("__first"), F.count(F.lit(1)).alias("__copies"))
        .where(F.col("__copies") > 1)
        .select(key, "__first")
    )
    joined = lookup_join(df, materialize(repeated), [key])
    return joined.withColumn(flag, holds(F.col(order) > F.col("__first"))).drop("__first")


def flag_rows(
    df: DataFrame, limits: Thresholds = ENFORCED, key: str = "trip_id", order: str = ROW_ORDER
) -> DataFrame:
    """Add ``reasons``: the names of all failed rules, empty for a clean row."""
    rules = row_rules(limits)
    if key not in df.columns:
        return df.withColumn("reasons", reasons_of(rules))
    marked = mark_duplicates(df, key, order, "__dup")
    return marked.withColumn(
        "reasons", reasons_of({**rules, "duplicate_trip_id": F.col("__dup")})
    ).drop("__dup")


def with_outcome(flagged: DataFrame) -> DataFrame:
    """Add ``outcome``, the name of the table a judged row belongs to."""
    return flagged.withColumn("outcome", F.when(F.size("reasons") == 0, "clean").otherwise("quarantine"))


def clean_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size("reasons") == 0).drop("reasons")


def quarantine_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size("reasons") > 0)


def validation_report(flagged: DataFrame, errors: list[str] | None = None) -> DataFrame:
    """One row of counters. Rule counters overlap; clean + quarantine = total."""
    counters = [
        F.count_if(F.array_contains("reasons", rule)).alias(name) for rule, name in RULE_COUNTERS.items()
    ]
    clean = F.count_if(F.size("reasons") == 0)
    total = F.count(F.lit(1))
    return flagged.agg(
        total.alias("total_rows"),
        *counters,
        clean.alias("clean_rows"),
        F.count_if(F.size("reasons") > 0).alias("quarantine_rows"),
        F.coalesce(F.try_divide(clean, total), F.lit(0.0)).alias("pass_rate"),
    ).withColumn("schema_errors", F.lit(errors or []).cast("array<string>"))


def reason_counts(flagged: DataFrame) -> DataFrame:
    """Rows per failed rule; a row failing two rules counts twice."""
    return (
        flagged.select(F.explode("reasons").alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def require_columns(df: DataFrame, columns: list[str] = REQUIRED_COLUMNS) -> DataFrame:
    errors = schema_errors(df, columns)
    if errors:
        raise ValidationFailed("; ".join(errors))
    return df


def require_pass_rate(report: DataFrame, minimum: float = MIN_PASS_RATE) -> None:
    rate = report.select("pass_rate").first()["pass_rate"]
    if rate < minimum:
        raise ValidationFailed(f"pass rate {rate:.1%} is below {minimum:.0%}")


# ------------------------------------------------------------- first generation


def rough_rules(limits: Thresholds) -> dict[str, Column]:
    """Three rule groups with a wide box and a duration window in seconds."""
    return {
        "missing_or_out_of_bounds_gps": out_of_range(limits),
        "invalid_timestamps_or_duration": invalid_timestamp() | invalid_duration(limits),
        "invalid_passenger_count": invalid_passengers(limits),
    }


def rough_report(df: DataFrame, limits: Thresholds) -> DataFrame:
    """Drop counts per rule group and the share of rows dropped, in percent."""
    rules = rough_rules(limits)
    bad = reduce(Column.__or__, rules.values())
    total, dropped = F.count(F.lit(1)), F.count_if(bad)
    return df.agg(
        total.alias("rows_in"),
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
        dropped.alias("total_rows_dropped"),
        (total - dropped).alias("rows_out"),
        F.coalesce(F.round(F.try_divide(dropped * 100.0, total), 2), F.lit(0.0)).alias("drop_rate_pct"),
    )


def rough_clean_rows(df: DataFrame, limits: Thresholds) -> DataFrame:
    return df.where(~reduce(Column.__or__, rough_rules(limits).values()))
