"""Row rules, quarantine, duplicates, weather enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.sql import box, using
from tripkit.operators import enrich, quality
from tripkit.schema import DOCUMENTED, MIN_PASS_RATE, ROUGH
from tripkit.session import materialize
from tripkit.sources import derived


def flagged(spark, sf, limits=quality.ENFORCED):
    return quality.flag_rows(derived.trips(spark, sf), limits)


def clean(spark, sf):
    return quality.clean_rows(flagged(spark, sf))


def lines(spark, sf, *columns):
    """Columns of the line items, dealt out to all cores if the file is a single split."""
    return derived.table(spark, sf, "lineitem").select(*columns)


def stored_lines(spark, sf, *columns):
    """The same, written once for statistics that need several passes."""
    return materialize(lines(spark, sf, *columns))


def stored_clean(spark, sf):
    """Clean trips written once to the shared folder, for statistics that read them repeatedly."""
    return materialize(clean(spark, sf))


def enriched(spark, sf):
    return enrich.enrich(clean(spark, sf), derived.weather(spark, sf))


def stored_enriched(spark, sf):
    return materialize(enriched(spark, sf))


RULES = ["missing_gps", "invalid_timestamp", "out_of_range", "invalid_eta", "invalid_passengers", "duplicate_trip_id"]
ANY_RULE = " OR ".join(RULES)
REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {r} THEN '{r}' END" for r in RULES) + ")"
COUNTERS = ", ".join(f"count(*) FILTER ({r}) AS {c}" for r, c in quality.RULE_COUNTERS.items())


def report_sql(any_rule: str = ANY_RULE) -> str:
    return f"""
      SELECT count(*) AS total_rows, {COUNTERS},
             count(*) FILTER (NOT ({any_rule})) AS clean_rows, count(*) FILTER ({any_rule}) AS quarantine_rows,
             count(*) FILTER (NOT ({any_rule})) / cast(count(*) as double) AS pass_rate"""


def validate_report(spark, sf):
    return quality.validation_report(flagged(spark, sf)).drop("schema_errors")


def documented_report(spark, sf):
    return quality.validation_report(flagged(spark, sf, DOCUMENTED)).drop("schema_errors")


DOCUMENTED_SQL = using("trips", f"""
WITH flagged AS (
  SELECT (pickup_lat IS NULL OR pickup_lon IS NULL OR dropoff_lat IS NULL OR dropoff_lon IS NULL) AS missing_gps,
    (dropoff_datetime IS NULL OR dropoff_datetime <= pickup_datetime) AS invalid_timestamp,
    NOT coalesce({box(DOCUMENTED.lat, DOCUMENTED.lon)}, false) AS out_of_range,
    NOT (eta_minutes > 0 AND eta_minutes BETWEEN 1 AND 120) AS invalid_eta,
    NOT (passenger_count BETWEEN 1 AND 6) AS invalid_passengers,
    row_number() OVER (PARTITION BY trip_id ORDER BY row_ord) > 1 AS duplicate_trip_id
  FROM trips)
{report_sql()} FROM flagged""")


def pass_gate(spark, sf):
    report = quality.validation_report(flagged(spark, sf))
    return report.select("total_rows", "pass_rate", (F.col("pass_rate") >= MIN_PASS_RATE).alias("passes"))


def rough_report(spark, sf):
    return quality.rough_report(derived.trips(spark, sf), ROUGH)


ROUGH_GPS = f"NOT coalesce({box(ROUGH.lat, ROUGH.lon)}, false)"
ROUGH_TIME = ("(dropoff_datetime IS NULL OR dropoff_datetime <= pickup_datetime"
              " OR NOT (trip_duration_sec BETWEEN 30 AND 21600))")
ROUGH_PASSENGERS = "NOT (passenger_count BETWEEN 1 AND 6)"
ROUGH_BAD = f"({ROUGH_GPS} OR {ROUGH_TIME} OR {ROUGH_PASSENGERS})"


def quarantine_rows(spark, sf):
    bad = quality.quarantine_rows(flagged(spark, sf))
    return bad.select("row_ord", "trip_id", F.array_join("reasons", ",").alias("reasons"))


def clean_trips(spark, sf):
    return clean(spark, sf).select("row_ord", "trip_id", "pickup_datetime", "passenger_count", "eta_minutes")


def dedup_first(spark, sf):
    marked = quality.mark_duplicates(derived.trips(spark, sf).select("row_ord", "trip_id"))
    return marked.select("row_ord", "trip_id", "is_duplicate")


def required_columns(spark, sf):
    """Schema check of a table that lacks two required columns, with the rows it holds."""
    short = derived.trips(spark, sf).drop("vendor_id", "eta_minutes")
    text = "; ".join(quality.schema_errors(short))
    return short.agg(F.count(F.lit(1)).alias("total_rows")).withColumn("schema_errors", F.lit(text))


# ------------------------------------------------------------------------ weather


def weather_dedup(spark, sf):
    """Each order is a reading of its date; the first one per date stays."""
    readings = derived.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_ord"), F.to_date("o_orderdate").alias("date"),
        (F.col("o_totalprice") / 5000.0).alias("avg_temp_f"),
    )
    return enrich.daily_weather(readings).orderBy("date").withColumn("date", F.col("date").cast("string"))


def weather_left_join(spark, sf):
    joined = enrich.join_weather(derived.trips(spark, sf), derived.weather(spark, sf))
    return joined.select("row_ord", "avg_temp_f", "precipitation", "snow_depth", "weather_matched")


def weather_median_fill(spark, sf):
    table = enrich.enrich(derived.trips(spark, sf), derived.weather(spark, sf))
    return table.select("row_ord", "avg_temp_f", "precipitation", "snow_depth")


def weather_absent(spark, sf):
    return enrich.enrich(derived.trips(spark, sf), None).select(
        "row_ord", "avg_temp_f", "precipitation", "snow_depth"
    )


def weather_coverage(spark, sf):
    return enrich.coverage(enrich.join_weather(derived.trips(spark, sf), derived.weather(spark, sf)))


def weather_span(spark, sf):
    return enrich.weather_span(derived.weather(spark, sf)).select(
        F.col("first_date").cast("string").alias("first_date"), F.col("last_date").cast("string").alias("last_date"),
        "n_days",
    )


JOIN = "FROM trips t LEFT JOIN weather w ON w.date = CAST(t.pickup_datetime AS DATE)"

QUERIES = {
    "validate_report": (validate_report, using("flagged", report_sql() + " FROM flagged")),
    "documented_report": (documented_report, DOCUMENTED_SQL),
    "pass_gate": (pass_gate, using("flagged", f"""
        SELECT count(*) AS total_rows, count(*) FILTER (NOT ({ANY_RULE})) / cast(count(*) as double) AS pass_rate,
               count(*) FILTER (NOT ({ANY_RULE})) / cast(count(*) as double) >= 0.8 AS passes FROM flagged""")),
    "rough_report": (rough_report, using("trips", f"""
        SELECT count(*) AS rows_in, count(*) FILTER ({ROUGH_GPS}) AS missing_or_out_of_bounds_gps,
               count(*) FILTER ({ROUGH_TIME}) AS invalid_timestamps_or_duration,
               count(*) FILTER ({ROUGH_PASSENGERS}) AS invalid_passenger_count,
               count(*) FILTER ({ROUGH_BAD}) AS total_rows_dropped, count(*) FILTER (NOT {ROUGH_BAD}) AS rows_out,
               round(count(*) FILTER ({ROUGH_BAD}) * cast(100 as double) / count(*), 2) AS drop_rate_pct
        FROM trips""")),
    "quarantine_reasons": (
        lambda s, d: quality.reason_counts(flagged(s, d)),
        using("flagged", "SELECT reason, count(*) AS n_rows FROM flagged, unnest(string_split("
                         f"{REASONS}, ',')) AS u(reason) WHERE {ANY_RULE} GROUP BY reason"),
    ),
    "quarantine_rows": (quarantine_rows, using(
        "flagged", f"SELECT row_ord, trip_id, {REASONS} AS reasons FROM flagged WHERE {ANY_RULE}")),
    "clean_rows": (clean_trips, using(
        "flagged", "SELECT row_ord, trip_id, pickup_datetime, passenger_count, eta_minutes FROM clean")),
    "dedup_first": (dedup_first, using("trips", """
        SELECT row_ord, trip_id, row_number() OVER (PARTITION BY trip_id ORDER BY row_ord) > 1 AS is_duplicate
        FROM trips""")),
    "required_columns": (required_columns, """
        SELECT count(*) AS total_rows,
               'missing required column: vendor_id; missing required column: eta_minutes' AS schema_errors
        FROM orders"""),
    "weather_dedup": (weather_dedup, """
        SELECT CAST(date AS VARCHAR) AS date, avg_temp_f FROM (
          SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice / cast(5000 as double) AS avg_temp_f,
                 row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS rn FROM orders)
        WHERE rn = 1"""),
    "weather_left_join": (weather_left_join, using("trips", f"""
        SELECT row_ord, avg_temp_f, precipitation, snow_depth, w.date IS NOT NULL AS weather_matched {JOIN}""", "weather")),
    "weather_median_fill": (weather_median_fill, using("trips", f"""
        SELECT row_ord, coalesce(avg_temp_f, (SELECT median(avg_temp_f) FROM weather)) AS avg_temp_f,
               coalesce(precipitation, 0) AS precipitation, coalesce(snow_depth, 0) AS snow_depth {JOIN}""", "weather")),
    "weather_absent": (weather_absent, """
        SELECT o_orderkey AS row_ord, cast(0 as double) AS avg_temp_f, cast(0 as double) AS precipitation,
               cast(0 as double) AS snow_depth FROM orders"""),
    "weather_coverage": (weather_coverage, using("trips", f"""
        SELECT count(*) AS n_trips, count(w.date) AS n_matched,
               round(count(w.date) / cast(count(*) as double), 6) AS coverage {JOIN}""", "weather")),
    "weather_span": (weather_span, using("weather", """
        SELECT CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date,
               count(date) AS n_days FROM weather""")),
}

