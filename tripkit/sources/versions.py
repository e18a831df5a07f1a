"""Immutable dataset versions: data partitioned by split, one append-only manifest.

A version counts as written once its manifest row exists; the row is appended after the
data, so a job that dies half way leaves nothing a reader would pick up.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkit.schema import TARGET
from tripkit.session import materialize

METADATA_SCHEMA = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("n_train", T.LongType()),
    T.StructField("n_val", T.LongType()),
    T.StructField("n_test", T.LongType()),
    T.StructField("numeric_features", T.ArrayType(T.StringType())),
    T.StructField("categorical_features", T.ArrayType(T.StringType())),
    T.StructField("scaler_type", T.StringType()),
    T.StructField("encoder_type", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("step_order", T.StringType()),
    T.StructField("medians", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("scaler", T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))),
    T.StructField("weather_fill", T.MapType(T.StringType(), T.DoubleType())),
])
# Fixed value: order of the preparation steps, recorded with each version.
STEP_ORDER = "split -> feature_engineering -> encode -> impute -> scale"


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def version_number(version: Column) -> Column:
    """N of ``vN``, null for any other name, so v10 comes after v9."""
    return F.regexp_extract(version, r"^v(\d+)$", 1).try_cast("bigint")


def latest_version(versions: DataFrame) -> DataFrame:
    """The numerically newest row of a table with a ``version`` column."""
    newest = F.max_by(F.struct(*versions.columns), version_number(F.col("version")))
    known = versions.where(version_number(F.col("version")).isNotNull())
    return known.agg(newest.alias("v")).where(F.col("v").isNotNull()).select("v.*")


def next_version(versions: DataFrame) -> DataFrame:
    """``v`` followed by the largest number plus one; names that are no version are ignored."""
    largest = F.coalesce(F.max(version_number(F.col("version"))), F.lit(0))
    return versions.agg(F.concat(F.lit("v"), (largest + 1).cast("string")).alias("next_version"))


def read_metadata(spark: SparkSession, base: str) -> DataFrame:
    try:
        return spark.read.schema(METADATA_SCHEMA).json(f"{base}/manifest")
    except AnalysisException:
        return spark.createDataFrame([], METADATA_SCHEMA)


def write_version(df: DataFrame, base: str, metadata: dict, version: str | None = None) -> str:
    """Write a prepared table with a ``split`` column as the next version; never overwrite."""
    spark = df.sparkSession
    version = version or next_version(read_metadata(spark, base)).first()["next_version"]
    path = f"{base}/{version}/data"
    df.write.partitionBy("split").mode("errorifexists").parquet(path)
    written = spark.read.parquet(path)
    counts = {r["split"]: r["n"] for r in written.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    row = {
        "target": TARGET, "step_order": STEP_ORDER, **metadata,
        "version": version, "created_at": utc_now().isoformat(),
        **{f"n_{s}": counts.get(s, 0) for s in ("train", "val", "test")},
    }
    values = [tuple(row.get(f.name) for f in METADATA_SCHEMA.fields)]
    spark.createDataFrame(values, METADATA_SCHEMA).coalesce(1).write.mode("append").json(f"{base}/manifest")
    return version


def load_version(spark: SparkSession, base: str, version: str) -> dict:
    """The three splits of a version and its metadata; an unknown version is an error."""
    rows = read_metadata(spark, base).where(F.col("version") == version).limit(1).collect()
    if not rows:
        raise FileNotFoundError(f"version {version} not found below {base}")
    data = spark.read.parquet(f"{base}/{version}/data")
    splits = {s: data.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")}
    return {**splits, "data": data, "metadata": rows[0].asDict(recursive=True)}


# ------------------------------------------------- baseline stored with a version


def store_baseline(profile: DataFrame, base: str, version: str) -> None:
    """Keep the profile that later data of a version are compared with; never overwrite."""
    profile.coalesce(1).write.mode("errorifexists").parquet(f"{base}/{version}/baseline")


def load_baseline(spark: SparkSession, base: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{version}/baseline")


# -------------------------------------------------------------- growing tables

APPEND_SCHEMA = "append_id string, columns array<string>, n_rows bigint, total decimal(38,0)"


def read_appends(spark: SparkSession, base: str) -> DataFrame:
    try:
        return spark.read.schema(APPEND_SCHEMA).parquet(f"{base}/appends")
    except AnalysisException:
        return spark.createDataFrame([], APPEND_SCHEMA)


def append_rows(df: DataFrame, base: str) -> str:
    """Add rows to a growing table, with the digest of these rows alone; returns the append's name.

    The digest is taken from the files written and listed after them: rows of a job that died half way
    belong to no append, and no reader sees them. Columns must be those of the first append, in any order.
    """
    from tripkit.operators.content import digest_totals

    spark = df.sparkSession
    first = read_appends(spark, base).select("columns").first()
    columns = first["columns"] if first else df.columns
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"columns {df.columns} differ from {columns} of the table below {base}")
    name = uuid.uuid4().hex
    path = f"{base}/rows/append_id={name}"
    df.select(*columns).write.mode("errorifexists").parquet(path)
    totals = digest_totals(spark.read.schema(df.select(*columns).schema).parquet(path)).first()
    row = (name, columns, totals["n_rows"], totals["total"])
    spark.createDataFrame([row], APPEND_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/appends")
    return name


def read_appended(spark: SparkSession, base: str) -> DataFrame:
    """All rows of the listed appends."""
    names = [r["append_id"] for r in read_appends(spark, base).select("append_id").collect()]
    if not names:
        raise FileNotFoundError(f"no rows below {base}")
    return spark.read.parquet(*(f"{base}/rows/append_id={n}" for n in names))


def appended_hash(spark: SparkSession, base: str) -> DataFrame:
    """Row count and content hash of a growing table from its digests; equal to ``content_hash`` of all of its rows."""
    from tripkit.operators.content import hash_of_totals, merged_totals

    return hash_of_totals(merged_totals(read_appends(spark, base)))


# ----------------------------------------------------------- snapshot manifest

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("version_id", T.StringType()),
    T.StructField("timestamp_utc", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("n_columns", T.IntegerType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("content_hash", T.StringType()),
    T.StructField("source_description", T.StringType()),
    T.StructField("validation_report", T.MapType(T.StringType(), T.DoubleType())),
])


def write_snapshot(df: DataFrame, base: str, source: str, report: dict | None = None) -> str:
    """Write a table under ``v_{utc}_{hash}`` and append its manifest row."""
    from tripkit.operators.content import digest_totals, hash_of

    spark, stamp = df.sparkSession, utc_now().strftime("%Y%m%dT%H%M%SZ")
    df = materialize(df)  # read for the hash and for the snapshot
    totals = digest_totals(df).first()
    digest = hash_of(totals)
    version_id = f"v_{stamp}_{digest}"
    df.write.mode("errorifexists").parquet(f"{base}/{version_id}.parquet")
    row = (
        version_id, stamp, f"{version_id}.parquet", totals["n_rows"], len(df.columns), df.columns, digest, source,
        {k: float(v) for k, v in (report or {}).items()},
    )
    spark.createDataFrame([row], SNAPSHOT_SCHEMA).coalesce(1).write.mode("append").json(f"{base}/manifest")
    return version_id


def read_snapshots(spark: SparkSession, base: str) -> DataFrame:
    try:
        return spark.read.schema(SNAPSHOT_SCHEMA).json(f"{base}/manifest")
    except AnalysisException:
        return spark.createDataFrame([], SNAPSHOT_SCHEMA)


def latest_per_source(manifest: DataFrame) -> DataFrame:
    """The newest snapshot of each source."""
    newest = F.max_by(F.struct(*manifest.columns), F.struct("timestamp_utc", "version_id"))
    return manifest.groupBy("source_description").agg(newest.alias("v")).select("v.*")
