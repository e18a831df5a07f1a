"""Exploratory statistics."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.features import BAND
from catalogue.quality import clean, enriched, lines, stored_clean, stored_enriched, stored_lines
from catalogue.sql import DISTANCE, DOW, HOUR, MONTH, RUSH, WEEKEND, row_hash, using
from tripkit.operators import sampling, stats
from tripkit.plans import profile
from tripkit.plans.features import build_features
from tripkit.session import materialize
from tripkit.sources import derived

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TRIP_NUMBERS = ["passenger_count", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", "eta_minutes"]
PAIRED = [
    "passenger_count", "hour_of_day", "day_of_week", "month", "is_weekend", "pickup_lat", "pickup_lon",
    "dropoff_lat", "dropoff_lon", "avg_temp_f", "precipitation", "snow_depth", "eta_minutes",
]


def rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---------------------------------------------------------------------- summaries


def describe(spark, sf):
    return stats.describe(stored_lines(spark, sf, *LINE_NUMBERS), LINE_NUMBERS)


def describe_trips(spark, sf):
    return stats.describe(materialize(derived.trips(spark, sf)), TRIP_NUMBERS, digits=6)


def describe_sql(tables: str, columns: list[str], source: str, digits: int = 4) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), {digits}) AS mean,
                   round(stddev_samp({c}), {digits}) AS std, round(cast(min({c}) as double), {digits}) AS min,
                   round(quantile_cont(cast({c} as double), 0.25), {digits}) AS p25,
                   round(quantile_cont(cast({c} as double), 0.5), {digits}) AS p50,
                   round(quantile_cont(cast({c} as double), 0.75), {digits}) AS p75,
                   round(cast(max({c}) as double), {digits}) AS max FROM {source}"""
        for c in columns
    ]
    body = "\nUNION ALL ".join(parts)
    return using(tables, body) if tables else body


def missing_counts(spark, sf):
    return stats.missing_counts(derived.trips(spark, sf))


TRIP_COLUMNS = [
    "row_ord", "trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "pickup_lon",
    "pickup_lat", "dropoff_lon", "dropoff_lat", "store_and_fwd_flag", "trip_duration_sec", "eta_minutes",
]
MISSING_SQL = using("trips", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_missing FROM trips""" for c in TRIP_COLUMNS))


def skew_kurtosis(spark, sf):
    return rounded(stats.shape_statistics(derived.table(spark, sf, "events"), ["value"]), ["skewness", "kurtosis"])


TYPED = ["orders", "lineitem", "events", "customer"]
TYPE_NAMES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
              "TIMESTAMP": "timestamp_ntz", "TIMESTAMP WITH TIME ZONE": "timestamp"}


def column_types(spark, sf):
    """Types of the columns of four tables."""
    tables = [stats.column_types(derived.table(spark, sf, name)).withColumn("table", F.lit(name)) for name in TYPED]
    return reduce(DataFrame.unionByName, tables)


TYPES_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", column_name AS \"column\", CASE column_type "
    + " ".join(f"WHEN '{theirs}' THEN '{ours}'" for theirs, ours in TYPE_NAMES.items())
    + f" ELSE column_type END AS type FROM (DESCRIBE {name})" for name in TYPED)


def corr_lower(spark, sf):
    wide = profile.calendar(stored_enriched(spark, sf))
    return rounded(stats.correlation_pairs(wide, PAIRED), ["corr"])


def corr_lower_lineitem(spark, sf):
    return rounded(stats.correlation_pairs(lines(spark, sf, *LINE_NUMBERS), LINE_NUMBERS), ["corr"])


def corr_sql(columns: list[str], source: str) -> str:
    def one(a, b):
        both = f"FILTER ({a} IS NOT NULL AND {b} IS NOT NULL)"
        spread = f"(stddev_pop({a}) {both} * stddev_pop({b}) {both})"
        return (f"SELECT '{a}' AS col_a, '{b}' AS col_b,"
                f" round(covar_pop({a}, {b}) / nullif({spread}, 0), 6) AS corr FROM {source}")

    return "\nUNION ALL ".join(one(a, b) for b, a in combinations(columns, 2))


CORR_SQL = using("enriched", f"""
WITH wide AS (
  SELECT passenger_count, {HOUR} AS hour_of_day, {DOW} AS day_of_week, {MONTH} AS month, {WEEKEND} AS is_weekend,
         pickup_lat, pickup_lon, dropoff_lat, dropoff_lon, avg_temp_f, precipitation, snow_depth, eta_minutes
  FROM enriched)
{corr_sql(PAIRED, 'wide')}""")


def value_counts(spark, sf):
    orders = derived.table(spark, sf, "orders")
    return stats.value_counts(orders, ["o_orderpriority", "o_orderstatus"])


def value_counts_trips(spark, sf):
    return stats.value_counts(clean(spark, sf), ["vendor_id", "store_and_fwd_flag"])


def counts_sql(columns: list[str], source: str) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n_rows FROM {source}
            WHERE {c} IS NOT NULL GROUP BY {c}""" for c in columns)


# --------------------------------------------------------------------- histograms


def edges(df):
    return rounded(df, ["bin_low", "bin_high"])


def histogram_sql(value: str, source: str, name: str, bins: int, digits: int = 6) -> str:
    return f"""
      SELECT '{name}' AS "column", bin, round(lo + bin * ((hi - lo) / {bins}), {digits}) AS bin_low,
             round(lo + (bin + 1) * ((hi - lo) / {bins}), {digits}) AS bin_high, count(*) AS n_rows
      FROM (SELECT CAST(least(floor((x - lo) * cast({bins} as double) / (hi - lo)), {bins - 1}) AS INTEGER) AS bin, lo, hi
            FROM (SELECT cast({value} as double) AS x FROM {source} WHERE {value} IS NOT NULL),
                 (SELECT min(cast({value} as double)) AS lo, max(cast({value} as double)) AS hi FROM {source}))
      GROUP BY bin, lo, hi"""


def hist_target(spark, sf):
    return edges(stats.histogram(stored_clean(spark, sf), ["eta_minutes"], profile.TARGET_BINS))


def hist_events(spark, sf):
    return edges(stats.histogram(derived.table(spark, sf, "events"), ["value"], profile.TARGET_BINS))


def hist_log(spark, sf):
    """Bins of a logarithm, counted on whole bins only (edges rounded)."""
    return edges(stats.log_histogram(stored_clean(spark, sf), "eta_minutes", profile.TARGET_BINS))


HIST_NUMERIC = ["passenger_count", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"]


def hist_numeric(spark, sf):
    return edges(stats.histogram(derived.trips(spark, sf), HIST_NUMERIC, profile.NUMERIC_BINS))


# -------------------------------------------------------------------- group means


def means(df):
    return df.withColumn("mean_target", F.round("mean_target", 6))


def mean_by_hour(spark, sf):
    return means(stats.mean_by(clean(spark, sf), F.hour("pickup_datetime"), "hour", "eta_minutes"))


def mean_by_month(spark, sf):
    return means(stats.mean_by(clean(spark, sf), F.month("pickup_datetime"), "month", "eta_minutes"))


def mean_by_weekday(spark, sf):
    return means(profile.mean_by_weekday(clean(spark, sf)))


def mean_by_temp_band(spark, sf):
    return means(profile.mean_by_temperature(enriched(spark, sf)))


def mean_rainy(spark, sf):
    from tripkit.functions.weather import rain_label

    return means(stats.mean_by(enriched(spark, sf), rain_label(F.col("precipitation")), "rain", "eta_minutes"))


def mean_snowing(spark, sf):
    from tripkit.functions.weather import is_snowing

    return means(stats.mean_by(enriched(spark, sf), is_snowing(F.col("snow_depth")), "is_snowing", "eta_minutes"))


def mean_sql(key: str, name: str, source: str) -> str:
    return using(source, f"SELECT {key} AS {name}, round(avg(eta_minutes), 6) AS mean_target,"
                         f" count(eta_minutes) AS n_rows FROM {'clean' if source == 'flagged' else source} GROUP BY 1")


def dense_sql(key: str, name: str, values: list[str], source: str) -> str:
    rows = ", ".join(f"({i}, '{v}')" for i, v in enumerate(values))
    table = "clean" if source == "flagged" else source
    return using(source, f"""
      SELECT CAST(ordinal AS INTEGER) AS ordinal, d.{name}, round(avg(eta_minutes), 6) AS mean_target,
             CASE WHEN count(eta_minutes) > 0 THEN count(eta_minutes) END AS n_rows
      FROM (VALUES {rows}) AS d(ordinal, {name})
      LEFT JOIN (SELECT {key} AS {name}, eta_minutes FROM {table}) t ON t.{name} = d.{name}
      GROUP BY ordinal, d.{name}""")


# --------------------------------------------------------------------- box, grids


def box_by_hour(spark, sf):
    wide = profile.calendar(stored_clean(spark, sf))
    return rounded(
        stats.box_statistics(wide, "hour_of_day", "eta_minutes"),
        ["q1", "median", "q3", "whisker_low", "whisker_high"],
    )


BOX_SQL = using("flagged", f"""
WITH t AS (SELECT {HOUR} AS hour_of_day, eta_minutes AS x FROM clean),
q AS (SELECT hour_of_day, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM t GROUP BY hour_of_day),
j AS (SELECT t.x, q.*, t.x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM t JOIN q USING (hour_of_day))
SELECT hour_of_day, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(min(x) FILTER (inside), 6) AS whisker_low, round(max(x) FILTER (inside), 6) AS whisker_high,
       count(*) FILTER (NOT inside) AS n_outliers, count(*) AS n_rows
FROM j GROUP BY hour_of_day, j.q1, j.median, j.q3""")


def hex_density(spark, sf):
    return rounded(stats.hex_density(stored_clean(spark, sf), "pickup_lon", "pickup_lat"), ["center_x", "center_y"])


HEX_SQL = using("flagged", """
WITH r AS (SELECT min(pickup_lon) AS x0, max(pickup_lon) AS x1, min(pickup_lat) AS y0, max(pickup_lat) AS y1 FROM clean),
s AS (SELECT (pickup_lon - x0) / ((x1 - x0) / 50) AS sx, (pickup_lat - y0) / ((y1 - y0) / 28) AS sy, r.* FROM clean, r),
d AS (SELECT *, (sx - floor(sx + 0.5)) * (sx - floor(sx + 0.5)) + (sy - floor(sy + 0.5)) * (sy - floor(sy + 0.5)) * cast(3 as double) AS d0,
                (sx - floor(sx) - 0.5) * (sx - floor(sx) - 0.5) + (sy - floor(sy) - 0.5) * (sy - floor(sy) - 0.5) * cast(3 as double) AS d1 FROM s),
c AS (SELECT CASE WHEN d0 < d1 THEN 0 ELSE 1 END AS lattice,
             CAST(CASE WHEN d0 < d1 THEN floor(sx + 0.5) ELSE floor(sx) END AS BIGINT) AS cell_x,
             CAST(CASE WHEN d0 < d1 THEN floor(sy + 0.5) ELSE floor(sy) END AS BIGINT) AS cell_y, x0, x1, y0, y1 FROM d)
SELECT CAST(lattice AS INTEGER) AS lattice, cell_x, cell_y, count(*) AS n_rows,
       round(x0 + (cell_x + lattice / cast(2 as double)) * ((x1 - x0) / 50), 6) AS center_x,
       round(y0 + (cell_y + lattice / cast(2 as double)) * ((y1 - y0) / 28), 6) AS center_y
FROM c GROUP BY lattice, cell_x, cell_y, x0, x1, y0, y1""")


def distance_target_grid(spark, sf):
    table = build_features(clean(spark, sf))
    return stats.grid_counts(table, "is_rush_hour", "haversine_km", "eta_minutes", 1.0, 5.0)


def table_shape(spark, sf):
    return stats.table_shape(derived.table(spark, sf, "lineitem"))


def seeded_sample(spark, sf):
    trips = derived.trips(spark, sf).select("row_ord", "trip_id", "eta_minutes")
    return sampling.seeded_sample(trips, F.col("row_ord"), 5000)


def head_rows(spark, sf):
    return sampling.head_rows(derived.trips(spark, sf), 100).select("row_ord", "trip_id", "eta_minutes")


QUERIES = {
    "table_shape": (table_shape, "SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns FROM lineitem"),
    "describe": (describe, describe_sql("", LINE_NUMBERS, "lineitem")),
    "describe_trips": (describe_trips, describe_sql("trips", TRIP_NUMBERS, "trips", 6)),
    "missing_counts": (missing_counts, MISSING_SQL),
    "skew_kurtosis": (skew_kurtosis, """
        SELECT 'value' AS "column", round(skewness(value), 6) AS skewness, round(kurtosis(value), 6) AS kurtosis
        FROM events"""),
    "column_types": (column_types, TYPES_SQL),
    "corr_lower": (corr_lower, CORR_SQL),
    "corr_lower_lineitem": (corr_lower_lineitem, corr_sql(LINE_NUMBERS, "lineitem")),
    "value_counts": (value_counts, counts_sql(["o_orderpriority", "o_orderstatus"], "orders")),
    "value_counts_trips": (value_counts_trips, using(
        "flagged", counts_sql(["vendor_id", "store_and_fwd_flag"], "clean"))),
    "hist_target": (hist_target, using("flagged", histogram_sql("eta_minutes", "clean", "eta_minutes", 60))),
    "hist_events": (hist_events, histogram_sql("value", "events", "value", 60)),
    "hist_log": (hist_log, using("flagged", f"""
        WITH logs AS (SELECT ln(1 + eta_minutes) AS v FROM clean)
        {histogram_sql("v", "logs", "log1p_eta_minutes", 60)}""")),
    "hist_numeric": (hist_numeric, using("trips", "\nUNION ALL ".join(
        histogram_sql(c, "trips", c, 40) for c in HIST_NUMERIC))),
    "mean_by_hour": (mean_by_hour, mean_sql(HOUR, "hour", "flagged")),
    "mean_by_month": (mean_by_month, mean_sql(MONTH, "month", "flagged")),
    "mean_by_weekday": (mean_by_weekday, dense_sql(
        "dayname(pickup_datetime)", "weekday",
        ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"], "flagged")),
    "mean_by_temp_band": (mean_by_temp_band, dense_sql(
        BAND, "temp_band",
        ["Freezing (<32F)", "Cold (32-50F)", "Cool (50-65F)", "Warm (65-80F)", "Hot (>80F)"], "enriched")),
    "mean_rainy": (mean_rainy, mean_sql(
        "CASE WHEN precipitation > 0.1 THEN 'Rainy' ELSE 'Dry' END", "rain", "enriched")),
    "mean_snowing": (mean_snowing, mean_sql("CAST(snow_depth > 0 AS INTEGER)", "is_snowing", "enriched")),
    "box_by_hour": (box_by_hour, BOX_SQL),
    "hex_density": (hex_density, HEX_SQL),
    "distance_target_grid": (distance_target_grid, using("flagged", f"""
        SELECT {RUSH} AS is_rush_hour, CAST(floor({DISTANCE}) AS BIGINT) AS x_bin,
               CAST(floor(eta_minutes / cast(5 as double)) AS BIGINT) AS y_bin, count(*) AS n_rows
        FROM clean GROUP BY 1, 2, 3""")),
    "seeded_sample": (seeded_sample, using("trips", f"""
        SELECT row_ord, trip_id, eta_minutes FROM trips ORDER BY {row_hash('row_ord')}, row_ord LIMIT 5000""")),
    "head_rows": (head_rows, using("trips", "SELECT row_ord, trip_id, eta_minutes FROM trips ORDER BY row_ord LIMIT 100")),
}
