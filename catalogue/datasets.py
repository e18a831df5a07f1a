"""Content hash, versions, manifests, registry stages and run metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.quality import RULES, clean, flagged, lines
from catalogue.sql import split_of, using
from tripkit.operators import quality, splitting
from tripkit.operators.content import content_hash
from tripkit.session import shared_path
from tripkit.sources import derived, readers, tracking, versions

def trip_hash(spark, sf):
    return content_hash(derived.trips(spark, sf))


def lineitem_hash(spark, sf):
    return content_hash(lines(spark, sf, "*"))


def appended_hash(spark, sf):
    """The hash of all line items from the digests of three appends."""
    base, table = shared_path(spark, "growing"), lines(spark, sf, "*")
    early, late = F.col("l_shipdate") < F.lit("1996-01-01"), F.col("l_shipdate") >= F.lit("1999-01-01")
    for part in (early, late, ~F.coalesce(early | late, F.lit(False))):
        versions.append_rows(table.where(part), base)
    return versions.appended_hash(spark, base)


def cell(column: str, kind: str) -> str:
    text = {"time": f"CAST(epoch_us({column}) AS VARCHAR)", "plain": f"CAST({column} AS VARCHAR)"}[kind]
    return f"coalesce(length({text}) || ':' || {text}, '-')"


def hash_sql(cells: list[str], source: str) -> str:
    return f"""
      SELECT n_rows, substr(sha256(CAST(n_rows AS VARCHAR) || '|' || CAST(total AS VARCHAR)), 1, 16) AS content_hash
      FROM (SELECT count(*) AS n_rows,
                   sum(CAST('0x' || substr(md5(concat({', '.join(cells)})), 1, 15) AS BIGINT)) AS total
            FROM {source})"""


TRIP_CELLS = [
    cell(c, "time" if c.endswith("datetime") else "plain") for c in (
        "row_ord", "trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "pickup_lon", "pickup_lat",
        "dropoff_lon", "dropoff_lat", "store_and_fwd_flag", "trip_duration_sec", "eta_minutes")
]
LINE_CELLS = [
    *[cell(c, "plain") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
    *[cell(c, "plain") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
    *[cell(c, "plain") for c in ("l_returnflag", "l_linestatus")], cell("l_shipdate", "time"),
]


def version_write_read(spark, sf):
    """Write split trips as an immutable version, read the splits back, and count."""
    base = shared_path(spark, "versions")
    table = splitting.hash_split(clean(spark, sf), "trip_id").select("row_ord", "eta_minutes", "split")
    version = versions.write_version(table, base, {"numeric_features": ["eta_minutes"], "scaler_type": "standard"})
    stored = versions.load_version(spark, base, version)
    meta = stored["metadata"]
    return stored["data"].groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("eta_minutes"), 4).alias("total"),
    ).withColumns({"version": F.lit(version), "n_train": F.lit(meta["n_train"]).cast("bigint")})


def quarantine_write_read(spark, sf):
    """Write judged trips partitioned by outcome, and read the quarantine part back."""
    path = shared_path(spark, "ingested")
    quality.with_outcome(flagged(spark, sf)).write.partitionBy("outcome").parquet(path)
    bad = spark.read.parquet(path).where(F.col("outcome") == "quarantine")
    return bad.groupBy(F.size("reasons").alias("n_reasons")).agg(F.count(F.lit(1)).alias("n_rows"))


N_REASONS = " + ".join(f"CAST({r} AS INTEGER)" for r in RULES)


def csv_write_read(spark, sf):
    """Trips written as raw CSV text, read back and typed by the trip reader."""
    path = shared_path(spark, "trips-csv")
    raw = derived.trips(spark, sf).select(
        F.col("trip_id").alias("id"), "vendor_id",
        F.col("pickup_datetime").cast("string").alias("pickup_datetime"),
        F.coalesce(F.col("dropoff_datetime").cast("string"), F.lit("not a time")).alias("dropoff_datetime"),
        F.concat(F.col("passenger_count").cast("string"), F.when(F.col("row_ord") % 3 == 0, ".7").otherwise(".0")
                 ).alias("passenger_count"),
        F.coalesce(F.col("pickup_lat").cast("string"), F.lit("n/a")).alias("pickup_latitude"),
        F.col("trip_duration_sec").alias("trip_duration"),
    )
    raw.write.csv(path, header=True)
    trips = readers.read_trips(spark, f"{path}/does-not-exist", path)
    return trips.drop("row_ord", "trip_duration_sec").fillna({"passenger_count": -1})


def weather_csv_read(spark, sf):
    """Order dates as a day-first weather CSV with repeats, read back one row per date."""
    path = shared_path(spark, "weather-csv")
    raw = derived.table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 10 == 0, "31-31-2016").otherwise(F.date_format("o_orderdate", "d-M-yyyy")).alias("Date"),
        F.dayofyear("o_orderdate").cast("string").alias(" Average Temperature "),
        F.when(F.month("o_orderdate") % 4 == 0, "T").otherwise("0.25").alias("precipitation"))
    raw.write.csv(path, header=True)
    table = readers.read_weather(spark, path)
    return table.select(
        F.col("date").cast("string").alias("date"), "avg_temp_f",
        F.coalesce("precipitation", F.lit(-1.0)).alias("precipitation"))


def version_names(spark, sf):
    """Version names from supplier keys, with names that are no version mixed in."""
    return derived.table(spark, sf, "supplier").select(
        F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("tmp"), F.col("s_suppkey")))
        .otherwise(F.concat(F.lit("v"), F.col("s_suppkey"))).alias("version"))


def next_version(spark, sf):
    return versions.next_version(version_names(spark, sf))


def latest_version(spark, sf):
    return versions.latest_version(version_names(spark, sf))


def manifest_latest(spark, sf):
    """Orders as snapshots: the priority is the source, the order date the time."""
    manifest = derived.table(spark, sf, "orders").select(
        F.concat(F.lit("v_"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("version_id"),
        F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss'Z'").alias("timestamp_utc"),
        F.col("o_custkey").alias("n_rows"), F.col("o_orderpriority").alias("source_description"))
    return versions.latest_per_source(manifest)


def stage_events(spark, sf):
    """Orders as stage events: one model per priority, 40 versions each."""
    stage = F.when(F.col("o_orderstatus") == "F", tracking.PRODUCTION).when(
        F.col("o_orderstatus") == "O", tracking.ARCHIVED).otherwise("Staging")
    return derived.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("event_ord"), F.col("o_orderpriority").alias("model"),
        (F.col("o_custkey") % 40 + 1).cast("int").alias("version"), stage.alias("stage"),
        F.concat(F.lit("v"), (F.col("o_custkey") % 7).cast("string")).alias("dataset_version"))


def stage_current(spark, sf):
    return tracking.current_stages(stage_events(spark, sf))


def production_version(spark, sf):
    return tracking.production_version(stage_events(spark, sf))


def run_metrics(spark, sf):
    return tracking.report_metrics(quality.validation_report(flagged(spark, sf)).drop("pass_rate"))


STAGES = """
e AS (SELECT o_orderkey, o_orderpriority AS model, CAST(o_custkey % 40 + 1 AS INTEGER) AS version,
             CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Archived' ELSE 'Staging' END AS stage,
             'v' || CAST(o_custkey % 7 AS VARCHAR) AS dataset_version FROM orders),
s AS (SELECT model, version, stage, dataset_version FROM
      (SELECT *, row_number() OVER (PARTITION BY model, version ORDER BY o_orderkey DESC) AS rn FROM e) WHERE rn = 1)"""

METRICS_SQL = using("flagged", "\nUNION ALL ".join(
    f"SELECT 'ingestion.{name}' AS key, cast(count(*) FILTER ({rule}) as double) AS value FROM flagged"
    for name, rule in [
        ("total_rows", "true"),
        *[(c, r) for r, c in quality.RULE_COUNTERS.items()],
        ("clean_rows", f"NOT ({' OR '.join(RULES)})"), ("quarantine_rows", " OR ".join(RULES)),
    ]))

HEAD = ["trip_id", "vendor_id", "passenger_count", "trip_duration_sec"]


def head_csv(spark, sf):
    """The first 100 trips in input order, written as a smaller CSV with a header and read back as text."""
    path = shared_path(spark, "head")
    readers.write_head_csv(derived.trips(spark, sf).select("row_ord", *HEAD), path, 100)
    return spark.read.csv(path, header=True)


QUERIES = {
    "head_csv": (head_csv, using("trips", f"""
        SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in HEAD)} FROM trips ORDER BY row_ord LIMIT 100""")),
    "content_hash": (trip_hash, using("trips", hash_sql(TRIP_CELLS, "trips"))),
    "content_hash_lineitem": (lineitem_hash, hash_sql(LINE_CELLS, "lineitem")),
    "content_hash_appended": (appended_hash, hash_sql(LINE_CELLS, "lineitem")),
    "version_write_read": (version_write_read, using("flagged", f"""
        WITH s AS (SELECT eta_minutes, {split_of('trip_id')} AS split FROM clean)
        SELECT split, count(*) AS n_rows, round(sum(eta_minutes), 4) AS total, 'v1' AS version,
               (SELECT count(*) FROM s WHERE split = 'train') AS n_train FROM s GROUP BY split""")),
    "quarantine_write_read": (quarantine_write_read, using("flagged", f"""
        SELECT CAST({N_REASONS} AS INTEGER) AS n_reasons, count(*) AS n_rows FROM flagged
        WHERE {' OR '.join(RULES)} GROUP BY 1""")),
    "csv_write_read": (csv_write_read, using("trips", """
        SELECT trip_id, vendor_id, pickup_datetime, dropoff_datetime,
               CASE WHEN row_ord % 3 <> 0 THEN passenger_count ELSE -1 END AS passenger_count, pickup_lat, eta_minutes
        FROM trips""")),
    "weather_csv_read": (weather_csv_read, """
        SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
               cast(dayofyear(o_orderdate) as double) AS avg_temp_f,
               CASE WHEN month(o_orderdate) % 4 = 0 THEN cast(-1 as double) ELSE cast(0.25 as double) END AS precipitation
        FROM orders WHERE o_orderkey % 10 <> 0"""),
    "next_version": (next_version, """
        SELECT 'v' || CAST(max(s_suppkey) + 1 AS VARCHAR) AS next_version FROM supplier WHERE s_suppkey % 3 <> 0"""),
    "latest_version": (latest_version, """
        SELECT 'v' || CAST(max(s_suppkey) AS VARCHAR) AS version FROM supplier WHERE s_suppkey % 3 <> 0"""),
    "manifest_latest": (manifest_latest, """
        SELECT version_id, timestamp_utc, n_rows, source_description FROM (
          SELECT 'v_' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS version_id,
                 strftime(o_orderdate, '%Y%m%dT%H%M%SZ') AS timestamp_utc, o_custkey AS n_rows,
                 o_orderpriority AS source_description,
                 row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
          FROM orders) WHERE rn = 1"""),
    "stage_current": (stage_current, f"WITH {STAGES} SELECT * FROM s"),
    "production_version": (production_version, f"""
        WITH {STAGES} SELECT model, max(version) AS version, max_by(dataset_version, version) AS dataset_version
        FROM s WHERE stage = 'Production' GROUP BY model"""),
    "run_metrics": (run_metrics, METRICS_SQL),
}
