"""Requests, scoring, monitoring and the streaming jobs."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from catalogue.quality import ANY_RULE, REASONS, stored_clean
from catalogue.sql import DISTANCE, HOUR, split_of, using
from tripkit.operators import enrich, monitoring, quality, scoring, splitting
from tripkit.plans import training
from tripkit.plans.features import build_features
from tripkit.plans.prepare import FittedPrep, fit_prep, prepare_and_version
from tripkit.plans.score import Scorer, load_scorer, register
from tripkit.session import materialize, shared_path
from tripkit.sources import derived
from tripkit.sources.versions import load_baseline, load_version, store_baseline, write_version
from tripkit.streaming import jobs, partials, repeats

# ----------------------------------------------------------------------- requests


def requests(spark, sf):
    """One scoring request per trip; some fields omitted, some not acceptable."""
    k = F.col("row_ord")

    def unless(n: int, value):
        return F.when(k % n != 0, value)

    return derived.trips(spark, sf).select(
        k.alias("request_ord"),
        F.when(k % 53 == 0, "tomorrow").otherwise(
            F.replace(F.col("pickup_datetime").cast("string"), F.lit(" "), F.lit("T"))).alias("pickup_datetime"),
        "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon",
        unless(4, F.col("passenger_count")).alias("passenger_count"),
        unless(6, (k % 3 + 1).cast("int")).alias("vendor_id"),
        F.when(k % 59 == 0, "Q").otherwise(F.col("store_and_fwd_flag")).alias("store_and_fwd_flag"),
        F.when(k % 61 == 0, "later").when(k % 2 == 0, F.col("dropoff_datetime").cast("string")).alias(
            "dropoff_datetime"),
        unless(3, (k % 90).cast("double")).alias("avg_temp_f"),
        unless(3, F.when(k % 67 == 0, -0.5).otherwise((k % 4) / 10.0)).alias("precipitation"),
        F.lit(None).cast("double").alias("snow_depth"),
    )


REQUESTS = """
req AS (
  SELECT row_ord AS request_ord, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon,
         CASE WHEN row_ord % 53 <> 0 THEN pickup_datetime END AS pickup_at, row_ord AS k,
         CASE WHEN row_ord % 4 <> 0 THEN passenger_count END AS passenger_count,
         CASE WHEN row_ord % 6 <> 0 THEN CAST(row_ord % 3 + 1 AS INTEGER) END AS vendor_id,
         CASE WHEN row_ord % 59 = 0 THEN 'Q' ELSE store_and_fwd_flag END AS store_and_fwd_flag,
         CASE WHEN row_ord % 61 = 0 THEN NULL WHEN row_ord % 2 = 0 THEN dropoff_datetime END AS dropoff_at,
         CASE WHEN row_ord % 3 <> 0 THEN cast(row_ord % 90 as double) END AS avg_temp_f,
         CASE WHEN row_ord % 3 <> 0 THEN CASE WHEN row_ord % 67 = 0 THEN cast(-0.5 as double)
              ELSE (row_ord % 4) / cast(10 as double) END END AS precipitation
  FROM trips)"""


def outside(c: str) -> str:
    low, high = (40.50, 40.92) if c.endswith("lat") else (-74.26, -73.68)
    return f"NOT coalesce({c} BETWEEN {low} AND {high}, false)"


REQUEST_RULES = [
    *[(c, outside(c)) for c in ("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon")],
    ("pickup_datetime", "k % 53 = 0"),
    ("passenger_count", "NOT coalesce(passenger_count, 1) BETWEEN 1 AND 6"),
    ("vendor_id", "NOT coalesce(vendor_id, 1) BETWEEN 1 AND 2"),
    ("precipitation", "coalesce(precipitation < 0, false)"),
    ("store_and_fwd_flag", "upper(trim(coalesce(store_and_fwd_flag, 'N'))) NOT IN ('Y', 'N')"),
    ("dropoff_datetime", "k % 61 = 0"),
]
REQUEST_ERRORS = "concat_ws(',', " + ", ".join(f"CASE WHEN {r} THEN '{c}' END" for c, r in REQUEST_RULES) + ")"


def request_validation(spark, sf):
    return scoring.validate_requests(requests(spark, sf)).select(
        "request_ord", F.array_join("errors", ",").alias("errors"))


def request_defaults(spark, sf):
    filled = scoring.with_defaults(requests(spark, sf))
    return filled.select(
        "request_ord", "pickup_datetime", "dropoff_datetime", "passenger_count", "vendor_id", "store_and_fwd_flag",
        "avg_temp_f", "precipitation", "snow_depth")


def request_weather(spark, sf):
    filled = scoring.look_up_weather(requests(spark, sf), derived.weather(spark, sf))
    return filled.select("request_ord", "avg_temp_f", "precipitation", "snow_depth")


def score_postprocess(spark, sf):
    raw = derived.table(spark, sf, "orders").select(
        "o_orderkey", ((F.col("o_totalprice") - 20000.0) / 7000.0).alias("prediction"))
    return scoring.postprocess(raw, "3", "v7", 34).drop("prediction")


def distance_scorer(spark, sf):
    """A scorer with one scaled feature and a least-squares line, fitted on train trips."""
    table = splitting.hash_split(build_features(stored_clean(spark, sf)), "trip_id")
    train = materialize(table.where(F.col("split") == "train").select("haversine_km", "eta_minutes"))
    fitted = fit_prep(train)
    data = training.assemble(
        fitted.apply(train).select("haversine_km", F.col("eta_minutes")), fitted.feature_names)
    model = LinearRegression(featuresCol="features", labelCol="label", solver="normal").fit(data)
    return Scorer(fitted, model, "1", "v1")


def stored_scorer(spark, sf):
    """The same scorer after a round trip: versioned data, registered model, both loaded."""
    base = shared_path(spark, "scorer")
    fresh = distance_scorer(spark, sf)
    table = splitting.hash_split(build_features(stored_clean(spark, sf)), "trip_id")
    ready = fresh.prep.apply(table).select("haversine_km", "eta_minutes", "split")
    version = write_version(ready, base, fresh.prep.metadata())
    register(fresh.model, base, spark, version)
    return load_scorer(spark, base)


def whole_scorer(spark, sf):
    """A scorer on all features with weather, trained on a stored version and loaded from the stores."""
    base = shared_path(spark, "whole-scorer")
    weather = materialize(derived.weather(spark, sf))
    version, fitted = prepare_and_version(
        enrich.enrich(stored_clean(spark, sf), weather), base, weather_fill=enrich.weather_fill(weather))
    data = training.assemble(load_version(spark, base, version)["train"], fitted.feature_names)
    model = LinearRegression(featuresCol="features", labelCol="label", solver="normal", regParam=0.01).fit(data)
    register(model, base, spark, version)
    return load_scorer(spark, base)


def batch_score_whole(spark, sf):
    """Every request answered by the scorer on all features; weather as given, looked up, or as stored with the version."""
    return answers(whole_scorer(spark, sf), spark, sf)


def stream_score_whole(spark, sf):
    """A stream of trips scored on all features, with weather by date or as stored with the version."""
    return scored_stream(whole_scorer(spark, sf), spark, sf)


def batch_score(spark, sf):
    """Every request answered, by a prediction or by the reason it cannot be."""
    return answers(distance_scorer(spark, sf), spark, sf)


def stored_model_score(spark, sf):
    """The same answers from a model and preparation loaded from the stores."""
    return answers(stored_scorer(spark, sf), spark, sf)


def answers(scorer, spark, sf):
    scored = scorer.score(requests(spark, sf), derived.weather(spark, sf))
    return scored.select(
        "request_ord", F.coalesce(F.col("eta_minutes"), F.lit(-1.0)).alias("eta_minutes"),
        F.coalesce("input_features", F.lit(0)).alias("input_features"), "error")


BATCH_SQL = using("flagged", f"""
WITH {REQUESTS},
o AS (SELECT regr_slope(eta_minutes, x) AS b, regr_intercept(eta_minutes, x) AS a FROM
      (SELECT eta_minutes, {DISTANCE} AS x FROM clean WHERE {split_of('trip_id')} = 'train')),
e AS (SELECT *, {REQUEST_ERRORS} AS errors FROM req)
SELECT request_ord, CASE WHEN errors = '' THEN round(greatest(a + b * {DISTANCE}, 0.1), 2) ELSE -1 END AS eta_minutes,
       CAST(errors = '' AS INTEGER) AS input_features,
       CASE WHEN errors <> '' THEN 'invalid ' || replace(errors, ',', ', ') END AS error
FROM e, o""")


def fill_modes(spark, sf):
    """Scaled feature of requests with a missing coordinate: train median or zero."""
    trips = derived.trips(spark, sf).select("row_ord", "passenger_count")
    gaps = trips.withColumn("passenger_count", F.when(F.col("row_ord") % 5 != 0, F.col("passenger_count")))
    fitted = FittedPrep(["passenger_count"], [], "ordinal", "standard", {"passenger_count": 3.0}, {"passenger_count": (2.0, 4.0)})
    return fitted.apply(gaps).select("row_ord", F.col("passenger_count").alias("by_median")).join(
        fitted.apply(gaps, "zero").select("row_ord", F.col("passenger_count").alias("by_zero")), "row_ord")


# --------------------------------------------------------------------- monitoring


def prediction_log(spark, sf):
    table = build_features(derived.trips(spark, sf))
    return table.select("trip_id", "pickup_datetime", (F.lit(20.0) + F.sqrt("haversine_km")).alias("prediction"))


def actuals(spark, sf):
    return derived.trips(spark, sf).select("row_ord", "trip_id", F.col("eta_minutes").alias("label"))


def accuracy(spark, sf):
    joined = monitoring.join_actuals(prediction_log(spark, sf), actuals(spark, sf))
    return monitoring.accuracy_by_window(joined, "pickup_datetime", "label", "prediction", digits=6)


ACCURACY = f"""
first AS (SELECT trip_id, label FROM (SELECT trip_id, eta_minutes AS label,
          row_number() OVER (PARTITION BY trip_id ORDER BY row_ord) AS rn FROM trips) WHERE rn = 1),
j AS (SELECT t.pickup_datetime, 20 + sqrt({DISTANCE}) - label AS e FROM trips t JOIN first USING (trip_id)),
a AS (SELECT CAST(date_trunc('day', pickup_datetime) AS TIMESTAMP) AS window_start, count(e) AS n_rows,
             round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(e), 6) AS bias
      FROM j GROUP BY 1)"""


DRIFTING = ["hour_of_day", "haversine_km", "eta_minutes"]


def drift_psi(spark, sf):
    table = build_features(stored_clean(spark, sf))
    before = F.col("pickup_datetime") < F.lit("1999-01-01").cast("timestamp_ntz")
    return monitoring.drift(table.where(before), table.where(~before), DRIFTING)


def drift_stored(spark, sf):
    """The same drift from a baseline profile that was stored with a version."""
    base = shared_path(spark, "baseline")
    table = build_features(stored_clean(spark, sf))
    before = F.col("pickup_datetime") < F.lit("1999-01-01").cast("timestamp_ntz")
    store_baseline(monitoring.baseline_profile(table.where(before), DRIFTING), base, "v1")
    return monitoring.drift_from(load_baseline(spark, base, "v1"), table.where(~before))


def stream_drift(spark, sf):
    """Drift of all trips per 30 days of a stream against the stored profile of the trips before 1999."""
    path = shared_path(spark, "stream-drift")
    before = build_features(derived.trips(spark, sf)).where(F.col("pickup_datetime") < F.lit("1999-01-01").cast("timestamp_ntz"))
    store_baseline(monitoring.baseline_profile(materialize(before.select(*DRIFTING)), DRIFTING), path, "v1")
    profile = load_baseline(spark, path, "v1")
    partials.monitor_drift(build_features(trip_stream(spark, sf)), profile, "pickup_datetime", f"{path}/counts", "30 days").awaitTermination()
    return partials.read_drift(spark, f"{path}/counts", profile)


#: Trips without a pickup place have no distance, and count in no bin of it.
STREAM_DRIFT_SQL = using("trips", f"""
WITH f AS (SELECT time_bucket(INTERVAL 30 DAY, pickup_datetime, TIMESTAMP '1970-01-01') AS window_start, pickup_datetime < TIMESTAMP '1999-01-01' AS early,
                  {HOUR} AS hour_of_day, {DISTANCE} AS haversine_km, eta_minutes FROM trips),
t AS ({" UNION ALL ".join(f"SELECT window_start, early, '{c}' AS name, CAST({c} AS DOUBLE) AS v FROM f WHERE {c} IS NOT NULL" for c in DRIFTING)}),
r AS (SELECT name, min(v) AS lo, max(v) AS hi FROM t WHERE early GROUP BY name),
b AS (SELECT window_start, early, name, CAST(least(floor((least(greatest(v, lo), hi) - lo) * cast(10 as double) / (hi - lo)), 9) AS BIGINT) AS bin
      FROM t JOIN r USING (name)),
p AS (SELECT name, bin, count(*) / cast(sum(count(*)) OVER (PARTITION BY name) as double) AS share FROM b WHERE early GROUP BY name, bin),
q AS (SELECT window_start, name, bin, count(*) / cast(sum(count(*)) OVER (PARTITION BY window_start, name) as double) AS share
      FROM b GROUP BY window_start, name, bin),
g AS (SELECT window_start, name, unnest(range(10)) AS bin FROM (SELECT DISTINCT window_start, name FROM q))
SELECT window_start, name AS "column", round(sum((qs - ps) * ln(qs / ps)), 6) AS psi FROM (
  SELECT g.window_start, g.name, greatest(coalesce(p.share, 0), cast(0.0001 as double)) AS ps, greatest(coalesce(q.share, 0), cast(0.0001 as double)) AS qs
  FROM g LEFT JOIN p USING (name, bin) LEFT JOIN q USING (window_start, name, bin)) GROUP BY window_start, name""")


def psi_sql() -> str:
    def one(c: str) -> str:
        return f"""
          SELECT '{c}' AS "column", round(sum((q - p) * ln(q / p)), 6) AS psi FROM (
            SELECT g.bin, greatest(coalesce(p.share, 0.0001), cast(0.0001 as double)) AS p,
                   greatest(coalesce(q.share, 0.0001), cast(0.0001 as double)) AS q
            FROM (SELECT unnest(range(10)) AS bin) g
            LEFT JOIN (SELECT bin, count(*) / cast(sum(count(*)) OVER () as double) AS share FROM b_{c} WHERE early GROUP BY bin) p USING (bin)
            LEFT JOIN (SELECT bin, count(*) / cast(sum(count(*)) OVER () as double) AS share FROM b_{c} WHERE NOT early GROUP BY bin) q USING (bin))"""

    columns = DRIFTING
    ranges = ", ".join(f"min({c}) FILTER (early) AS lo_{c}, max({c}) FILTER (early) AS hi_{c}" for c in columns)
    binned = ", ".join(
        f"b_{c} AS (SELECT early, CAST(least(floor((least(greatest({c}, lo_{c}), hi_{c}) - lo_{c}) * cast(10 as double)"
        f" / (hi_{c} - lo_{c})), 9) AS BIGINT) AS bin FROM f, r)" for c in columns)
    return using("flagged", f"""
      WITH f AS (SELECT pickup_datetime < TIMESTAMP '1999-01-01' AS early, {HOUR} AS hour_of_day,
                        {DISTANCE} AS haversine_km, eta_minutes FROM clean),
      r AS (SELECT {ranges} FROM f), {binned}
      {" UNION ALL ".join(one(c) for c in columns)}""")


# ---------------------------------------------------------------------- streaming


def trip_stream(spark, sf):
    return derived.trips_of_orders(jobs.read_table_stream(spark, sf, "orders.parquet"))


def stream_validate(spark, sf):
    """Judge trips as a stream; the written partitions add up to the batch outcome."""
    path = shared_path(spark, "stream-validate")
    jobs.route(trip_stream(spark, sf), path).awaitTermination()
    return spark.read.parquet(f"{path}/data").groupBy(
        "outcome", F.array_join("reasons", ",").alias("reasons")).agg(F.count(F.lit(1)).alias("n_rows"))


def stream_quarantine(spark, sf):
    """Trips as a stream, repeated ids included: the quarantined rows of the batch with their reasons."""
    path = shared_path(spark, "stream-quarantine")
    repeats.append_all(trip_stream(jobs.stateful_session(spark, 8), sf), path)
    judged = repeats.read_judged(spark, path).where("outcome = 'quarantine'")
    return judged.select("row_ord", "trip_id", F.array_join("reasons", ",").alias("reasons"))


ROW_RULES = [r for r in quality.RULE_COUNTERS if r != "duplicate_trip_id"]
ROW_REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {r} THEN '{r}' END" for r in ROW_RULES) + ")"


def stream_dedup(spark, sf):
    """Trip ids that come out of a streaming deduplication: each one once."""
    path = shared_path(spark, "stream-dedup")
    slim = trip_stream(jobs.stateful_session(spark, 8), sf).select("row_ord", "trip_id", "pickup_datetime")
    kept = jobs.deduplicate(slim, "trip_id", "pickup_datetime")
    jobs.write_stream(kept.select("trip_id"), path).awaitTermination()
    return spark.read.parquet(f"{path}/data")


def stream_score(spark, sf):
    """Score a stream of trips with the same scorer as the batch."""
    return scored_stream(distance_scorer(spark, sf), spark, sf)


def scored_stream(scorer, spark, sf):
    path = shared_path(spark, "stream-score")
    good = jobs.validate(trip_stream(spark, sf)).where(F.col("outcome") == "clean").drop("reasons", "outcome")
    scored = jobs.score(good, scorer, derived.weather(spark, sf))
    jobs.write_stream(scored.select("row_ord", "prediction"), path).awaitTermination()
    return spark.read.parquet(f"{path}/data").select("row_ord", F.round("prediction", 4).alias("prediction"))


STREAM_SCORE_SQL = using("flagged", f"""
WITH o AS (SELECT regr_slope(eta_minutes, x) AS b, regr_intercept(eta_minutes, x) AS a FROM
      (SELECT eta_minutes, {DISTANCE} AS x FROM clean WHERE {split_of('trip_id')} = 'train'))
SELECT row_ord, round(a + b * {DISTANCE}, 4) AS prediction FROM flagged, o WHERE NOT ({' OR '.join(ROW_RULES)})""")


def stream_monitor(spark, sf):
    """Accuracy per day of streamed predictions joined to streamed actuals, from sums appended by each trigger."""
    path = shared_path(spark, "stream-monitor")
    session = jobs.stateful_session(spark, 8)
    source = trip_stream(session, sf)
    log = build_features(source).select("row_ord", "pickup_datetime", (F.lit(20.0) + F.sqrt("haversine_km")).alias("prediction"))
    seen = source.select("row_ord", F.col("dropoff_datetime").alias("actual_at"), F.col("eta_minutes").alias("label"))
    partials.monitor_windows(log, seen, "row_ord", "pickup_datetime", path).awaitTermination()
    return partials.read_windows(spark, path, 6)


#: An actual counts within a day of its prediction; a trip without a pickup place has no prediction, but a window.
STREAM_MONITOR_SQL = using("trips", f"""
SELECT CAST(date_trunc('day', pickup_datetime) AS TIMESTAMP) AS window_start, count(e) AS n_rows,
       round(avg(abs(e)), 6) AS mae, round(sqrt(avg(e * e)), 6) AS rmse, round(avg(e), 6) AS bias
FROM (SELECT pickup_datetime, 20 + sqrt({DISTANCE}) - eta_minutes AS e FROM trips
      WHERE dropoff_datetime BETWEEN pickup_datetime AND pickup_datetime + INTERVAL 1 DAY) GROUP BY 1""")

QUERIES = {
    "request_validation": (request_validation, using("trips", f"""
        WITH {REQUESTS} SELECT request_ord, {REQUEST_ERRORS} AS errors FROM req""")),
    "request_defaults": (request_defaults, using("trips", f"""
        WITH {REQUESTS}
        SELECT request_ord, pickup_at AS pickup_datetime, coalesce(dropoff_at, pickup_at) AS dropoff_datetime,
               coalesce(passenger_count, 1) AS passenger_count, coalesce(vendor_id, 1) AS vendor_id,
               coalesce(store_and_fwd_flag, 'N') AS store_and_fwd_flag, coalesce(avg_temp_f, 0) AS avg_temp_f,
               coalesce(precipitation, 0) AS precipitation, cast(0 as double) AS snow_depth
        FROM req""")),
    "request_weather": (request_weather, using("trips", f"""
        WITH {REQUESTS}
        SELECT request_ord, coalesce(r.avg_temp_f, w.avg_temp_f) AS avg_temp_f,
               coalesce(r.precipitation, w.precipitation) AS precipitation, w.snow_depth
        FROM req r LEFT JOIN weather w ON w.date = CAST(pickup_at AS DATE)""", "weather")),
    "score_postprocess": (score_postprocess, """
        WITH p AS (SELECT o_orderkey, greatest((o_totalprice - 20000) / cast(7000 as double), 0.1) AS m FROM orders)
        SELECT o_orderkey, round(m, 2) AS eta_minutes, CAST(round_even(m * 60, 0) AS INTEGER) AS eta_seconds,
               'eta-best-model' AS model_name, '3' AS model_version, 'v7' AS dataset_version,
               CAST(34 AS INTEGER) AS input_features FROM p"""),
    "score_fill_modes": (fill_modes, using("trips", """
        WITH g AS (SELECT row_ord, CASE WHEN row_ord % 5 <> 0 THEN cast(passenger_count as double) END AS x FROM trips)
        SELECT row_ord, (coalesce(x, 3) - 2) / cast(4 as double) AS by_median, (coalesce(x, 0) - 2) / cast(4 as double) AS by_zero
        FROM g""")),
    "batch_score": (batch_score, BATCH_SQL),
    "stored_model_score": (stored_model_score, BATCH_SQL),
    "batch_score_whole": (batch_score_whole, None),
    "stream_score_whole": (stream_score_whole, None),
    "accuracy_by_window": (accuracy, using("trips", f"WITH {ACCURACY} SELECT * FROM a")),
    "retrain_trigger": (
        lambda s, d: monitoring.retrain_signal(accuracy(s, d), 30.0, 1.2).select("window_start", "rmse", "retrain"),
        using("trips", f"WITH {ACCURACY} SELECT window_start, rmse, coalesce(rmse > 36, false) AS retrain FROM a")),
    "drift_psi": (drift_psi, psi_sql()),
    "drift_stored": (drift_stored, psi_sql()),
    "stream_drift": (stream_drift, STREAM_DRIFT_SQL),
    "stream_validate": (stream_validate, using("flagged", f"""
        SELECT CASE WHEN {' OR '.join(ROW_RULES)} THEN 'quarantine' ELSE 'clean' END AS outcome, {ROW_REASONS} AS reasons, count(*) AS n_rows
        FROM flagged GROUP BY 1, 2""")),
    "stream_quarantine": (stream_quarantine, using(
        "flagged", f"SELECT row_ord, trip_id, {REASONS} AS reasons FROM flagged WHERE {ANY_RULE}")),
    "stream_dedup": (stream_dedup, using("trips", "SELECT DISTINCT trip_id FROM trips")),
    "stream_score": (stream_score, STREAM_SCORE_SQL),
    "stream_monitor": (stream_monitor, STREAM_MONITOR_SQL),
}
