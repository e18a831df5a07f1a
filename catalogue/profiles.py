"""The whole profile of all features, every table by its values."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.features import BAND
from catalogue.quality import stored_enriched
from catalogue.sql import using
from catalogue.statistics import counts_sql, describe_sql, histogram_sql
from tripkit.plans import profile
from tripkit.plans.features import build_features
from tripkit.schema import PROFILE_CATEGORICALS, PROFILE_NUMERICS, TARGET
from tripkit.session import materialize

COLUMNS = ["pickup_datetime", *PROFILE_CATEGORICALS, *PROFILE_NUMERICS, TARGET]
#: Columns that name a row of each table, and its values.
SHAPES = {
    "shape": ([], ["n_rows", "n_columns"]),
    "types": (["column", "type"], []),
    "missing": (["column"], ["n_missing"]),
    "describe": (["column"], ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]),
    "target_shape": (["column"], ["skewness", "kurtosis"]),
    **{n: (["column", "bin"], ["bin_low", "bin_high", "n_rows"]) for n in ("target_histogram", "target_log_histogram", "numeric_histograms")},
    "value_counts": (["column", "value"], ["n_rows"]),
    "correlation": (["col_a", "col_b"], ["corr"]),
    "distance_target": (["is_rush_hour", "x_bin", "y_bin"], ["n_rows"]),
    **{f"mean_by_{n}": (k, ["mean_target", "n_rows"]) for n, k in (
        ("hour", ["hour"]), ("weekday", ["ordinal", "weekday"]), ("month", ["month"]), ("temperature", ["ordinal", "temp_band"]),
        ("rain", ["rain"]), ("snow", ["is_snowing"]))},
    "pickup_density": (["lattice", "cell_x", "cell_y"], ["n_rows", "center_x", "center_y"]),
    "box_by_hour": (["hour_of_day"], ["q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers", "n_rows"]),
}


def nudge(measure: str) -> float:
    """Edges of bins are decimal fractions, which six places may round at a half: a billionth moves them off it."""
    return 1e-9 if measure.startswith("bin_") else 0.0


def long_rows(name: str, table: DataFrame) -> DataFrame:
    """name, key, measure, value of every row of a table."""
    keys, values = SHAPES[name]
    cells = [F.struct(F.lit(v).alias("measure"), F.round(F.col(v).cast("double") + nudge(v), 6).alias("value")) for v in values]
    cells = cells or [F.struct(F.lit("is").alias("measure"), F.lit(1.0).alias("value"))]
    return table.select(F.lit(name).alias("name"), F.concat_ws("|", *(F.col(k).cast("string") for k in keys)).alias("key"), F.inline(F.array(*cells)))


def features(spark, sf):
    return materialize(build_features(stored_enriched(spark, sf)).select(*COLUMNS))


def profile_tables(spark, sf):
    """Every value of every exploratory table of all features."""
    tables, failures = profile.profile(features(spark, sf))
    if failures:
        raise RuntimeError(f"profile failed in part: {failures}")
    return reduce(DataFrame.unionByName, [long_rows(n, t) for n, t in sorted(tables.items())])


# ------------------------------------------------------------------------------ SQL

KINDS = {"pickup_datetime": "timestamp_ntz", "vendor_id": "int", "store_and_fwd_flag": "int", "passenger_count": "int",
         **dict.fromkeys(["hour_of_day", "day_of_week", "month", "is_weekend", "is_rush_hour", "is_snowing", "is_raining"], "int"),
         **dict.fromkeys(["avg_temp_f", "precipitation", "snow_depth"], "float")}
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
BANDS = ["Freezing (<32F)", "Cold (32-50F)", "Cool (50-65F)", "Warm (65-80F)", "Hot (>80F)"]


def mean_of(key: str, name: str) -> str:
    return f"SELECT {key} AS {name}, avg(eta_minutes) AS mean_target, count(eta_minutes) AS n_rows FROM p GROUP BY 1"


def dense_of(key: str, name: str, values: list[str]) -> str:
    rows = ", ".join(f"({i}, '{v}')" for i, v in enumerate(values))
    return f"""SELECT ordinal, d.{name}, mean_target, n_rows FROM (VALUES {rows}) AS d(ordinal, {name})
               LEFT JOIN ({mean_of(key, name)}) t ON t.{name} = d.{name}"""


def correlations() -> str:
    pairs = [(a, b) for b, a in combinations([*PROFILE_NUMERICS, TARGET], 2)]
    values = ", ".join(f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)" for a, b in pairs)
    names = [", ".join(f"'{p[k]}'" for p in pairs) for k in (0, 1)]
    return f"SELECT unnest([{names[0]}]) AS col_a, unnest([{names[1]}]) AS col_b, unnest(c) AS corr FROM (SELECT [{values}] AS c FROM p)"


PLOTTED = [c for c in PROFILE_NUMERICS if c != "is_weekend"]
NUMBERS = [c for c in COLUMNS if c != "pickup_datetime"]
TABLES = {
    "shape": f"SELECT count(*) AS n_rows, {len(COLUMNS)} AS n_columns FROM p",
    "types": "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{KINDS.get(c, 'double')}')" for c in COLUMNS) + ') AS t("column", type)',
    "missing": f"""SELECT unnest([{', '.join(f"'{c}'" for c in COLUMNS)}]) AS "column",
                   unnest(c) AS n_missing FROM (SELECT [{', '.join(f'count(*) - count({c})' for c in COLUMNS)}] AS c FROM p)""",
    "describe": describe_sql("", NUMBERS, "p"),
    "target_shape": "SELECT 'eta_minutes' AS \"column\", skewness(eta_minutes) AS skewness, kurtosis(eta_minutes) AS kurtosis FROM p",
    "target_histogram": histogram_sql("eta_minutes", "p", "eta_minutes", 60, 12),
    "target_log_histogram": histogram_sql("v", "(SELECT ln(1 + eta_minutes) AS v FROM p)", "log1p_eta_minutes", 60, 12),
    "numeric_histograms": "\nUNION ALL ".join(histogram_sql(c, "p", c, 40, 12) for c in PLOTTED),
    "value_counts": counts_sql(PROFILE_CATEGORICALS, "p"),
    "correlation": correlations(),
    "distance_target": """SELECT is_rush_hour, CAST(floor(haversine_km) AS BIGINT) AS x_bin, CAST(floor(eta_minutes / cast(5 as double)) AS BIGINT) AS y_bin,
                          count(*) AS n_rows FROM p GROUP BY 1, 2, 3""",
    "mean_by_hour": mean_of("hour_of_day", "hour"), "mean_by_month": mean_of("month", "month"),
    "mean_by_weekday": dense_of("dayname(pickup_datetime)", "weekday", WEEKDAYS), "mean_by_temperature": dense_of(BAND, "temp_band", BANDS),
    "mean_by_rain": mean_of("CASE WHEN CAST(precipitation AS DOUBLE) > cast(0.1 as double) THEN 'Rainy' ELSE 'Dry' END", "rain"),
    "mean_by_snow": mean_of("CAST(snow_depth > 0 AS INTEGER)", "is_snowing"),
    "pickup_density": """
        WITH r AS (SELECT min(pickup_lon) AS x0, max(pickup_lon) AS x1, min(pickup_lat) AS y0, max(pickup_lat) AS y1 FROM p),
        s AS (SELECT (pickup_lon - x0) / ((x1 - x0) / 50) AS sx, (pickup_lat - y0) / ((y1 - y0) / 28) AS sy, r.* FROM p, r),
        d AS (SELECT *, (sx - floor(sx + 0.5)) * (sx - floor(sx + 0.5)) + (sy - floor(sy + 0.5)) * (sy - floor(sy + 0.5)) * cast(3 as double)
                        < (sx - floor(sx) - 0.5) * (sx - floor(sx) - 0.5) + (sy - floor(sy) - 0.5) * (sy - floor(sy) - 0.5) * cast(3 as double) AS nearer FROM s),
        c AS (SELECT CAST(NOT nearer AS INTEGER) AS lattice, CAST(floor(sx + CASE WHEN nearer THEN 0.5 ELSE 0 END) AS BIGINT) AS cell_x,
                     CAST(floor(sy + CASE WHEN nearer THEN 0.5 ELSE 0 END) AS BIGINT) AS cell_y, x0, x1, y0, y1 FROM d)
        SELECT lattice, cell_x, cell_y, count(*) AS n_rows, x0 + (cell_x + lattice / cast(2 as double)) * ((x1 - x0) / 50) AS center_x,
               y0 + (cell_y + lattice / cast(2 as double)) * ((y1 - y0) / 28) AS center_y FROM c GROUP BY lattice, cell_x, cell_y, x0, x1, y0, y1""",
    "box_by_hour": """
        WITH q AS (SELECT hour_of_day, quantile_cont(eta_minutes, 0.25) AS q1, quantile_cont(eta_minutes, 0.5) AS median,
                          quantile_cont(eta_minutes, 0.75) AS q3 FROM p GROUP BY hour_of_day),
        j AS (SELECT eta_minutes AS x, q.*, eta_minutes BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM p JOIN q USING (hour_of_day))
        SELECT hour_of_day, q1, median, q3, min(x) FILTER (inside) AS whisker_low, max(x) FILTER (inside) AS whisker_high,
               count(*) FILTER (NOT inside) AS n_outliers, count(*) AS n_rows FROM j GROUP BY hour_of_day, q1, median, q3""",
}


def long_sql(name: str) -> str:
    keys, values = SHAPES[name]
    key = "concat_ws('|', " + ", ".join(f'CAST("{k}" AS VARCHAR)' for k in keys) + ")" if keys else "''"
    measures = ", ".join(f"'{v}'" for v in values) or "'is'"
    numbers = ", ".join(f'round(CAST("{v}" AS DOUBLE) + cast({nudge(v)} as double), 6)' for v in values) or "cast(1 as double)"
    return f"SELECT '{name}' AS name, {key} AS key, unnest([{measures}]) AS measure, unnest([{numbers}]) AS value FROM ({TABLES[name]})"


PROFILE_SQL = using("features", f"WITH p AS (SELECT {', '.join(COLUMNS)} FROM features)\n" + "\nUNION ALL ".join(long_sql(n) for n in SHAPES))

QUERIES = {"profile_tables": (profile_tables, PROFILE_SQL)}
