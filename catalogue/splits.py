"""Strata, splits, encoders, imputation, scalers and location bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.quality import stored_clean, stored_enriched, stored_lines
from catalogue.sql import row_hash, split_of, using
from tripkit.functions.keys import row_hash as hash_column
from tripkit.operators import prep, splitting
from tripkit.plans import first_generation, prepare
from tripkit.schema import COORDINATES
from tripkit.session import materialize
from tripkit.sources import derived

# ------------------------------------------------------------------------- strata

EDGES = ("SELECT " + ", ".join(f"quantile_cont(eta_minutes, {i / 5}) AS e{i}" for i in range(1, 5))
         + " FROM clean")
STRATUM = "CAST(" + " + ".join(f"CAST(eta_minutes > e{i} AS INTEGER)" for i in range(1, 5)) + " AS INTEGER)"


def qcut_strata(spark, sf):
    return splitting.add_strata(stored_clean(spark, sf)).select("row_ord", "stratum")


def qcut_strata_tied(spark, sf):
    """Quantity has 50 distinct values, so rows at an edge must fall on the same side."""
    return splitting.add_strata(stored_lines(spark, sf, "l_quantity"), "l_quantity").groupBy("l_quantity", "stratum").agg(
        F.count(F.lit(1)).alias("n_rows"))


def stratified_split(spark, sf):
    stratified = splitting.add_strata(stored_clean(spark, sf))
    return splitting.hash_split(stratified, "trip_id").groupBy("stratum", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("eta_minutes"), 4).alias("total"))


def stratified_split_exact(spark, sf):
    stratified = splitting.add_strata(stored_clean(spark, sf))
    return splitting.exact_split(stratified, "trip_id").select("row_ord", "stratum", "split")


# Largest remainder, twice: first (train + val) against test, then train against val.
EXACT_SQL = using("flagged", f"""
WITH e AS ({EDGES}),
s AS (SELECT row_ord, {STRATUM} AS stratum, {row_hash('trip_id')} AS h FROM clean, e),
n AS (SELECT count(*) AS n, CAST(ceil(cast(0.2 as double) * count(*)) AS BIGINT) AS n_test FROM s),
c AS (SELECT stratum, count(*) AS c FROM s GROUP BY stratum),
k1 AS (SELECT stratum, c, c * (n - n_test) // n AS base, c * (n - n_test) % n AS rem, n - n_test AS take FROM c, n),
k2 AS (SELECT stratum, c, take, base + CAST(row_number() OVER (ORDER BY rem DESC, stratum)
         <= take - sum(base) OVER () AS INTEGER) AS kept FROM k1),
m AS (SELECT stratum, c, kept, take - CAST(ceil(cast(0.125 as double) * take) AS BIGINT) AS n_train, take FROM k2),
t1 AS (SELECT *, kept * n_train // take AS base, kept * n_train % take AS rem FROM m),
t2 AS (SELECT stratum, c, kept, base + CAST(row_number() OVER (ORDER BY rem DESC, stratum)
         <= n_train - sum(base) OVER () AS INTEGER) AS train FROM t1),
r AS (SELECT row_ord, stratum, row_number() OVER (PARTITION BY stratum ORDER BY h, row_ord) AS pos FROM s)
SELECT row_ord, r.stratum, CASE WHEN pos <= c - kept THEN 'test' WHEN pos <= c - train THEN 'val' ELSE 'train' END AS split
FROM r JOIN t2 USING (stratum)""")


def split_sizes(spark, sf):
    stratified = splitting.add_strata(stored_clean(spark, sf))
    return splitting.split_counts(splitting.exact_split(stratified, "trip_id"))


def split_cover(spark, sf):
    """Keys of each part of the exact split, and whether parts overlap or leave rows out."""
    stratified = splitting.add_strata(stored_clean(spark, sf))
    return splitting.split_cover(stratified, splitting.exact_split(stratified, "trip_id"))


COVER_SQL = EXACT_SQL.replace("SELECT row_ord, r.stratum, CASE", """
SELECT split, count(*) AS n_keys, count(*) FILTER (parts > 1) AS n_shared, count(*) FILTER (row_ord NOT IN (SELECT row_ord FROM clean)) AS n_foreign
FROM (SELECT row_ord, split, count(*) OVER (PARTITION BY row_ord) AS parts FROM (SELECT row_ord, CASE""") + ")) GROUP BY split"


SIZES_SQL = using("flagged", """
WITH n AS (SELECT count(*) AS n, CAST(ceil(cast(0.2 as double) * count(*)) AS BIGINT) AS n_test FROM clean),
v AS (SELECT n, n_test, CAST(ceil(cast(0.125 as double) * (n - n_test)) AS BIGINT) AS n_val FROM n)
SELECT 'test' AS split, n_test AS n_rows FROM v UNION ALL SELECT 'val', n_val FROM v
UNION ALL SELECT 'train', n - n_test - n_val FROM v""")


def hash_split(spark, sf):
    return splitting.hash_split(derived.trips(spark, sf), "trip_id").select("row_ord", "split")


def time_split(spark, sf):
    return splitting.time_split(stored_clean(spark, sf)).select("row_ord", "split")


def time_split_tied(spark, sf):
    """Order dates repeat often, so the cut falls between equal times."""
    orders = derived.table(spark, sf, "orders").withColumnRenamed("o_orderkey", "row_ord")
    return splitting.time_split(orders, at="o_orderdate").select("row_ord", "split")


def time_sql(at: str, order: str, source: str) -> str:
    return f"""
      SELECT {order} AS row_ord, CASE WHEN pos <= n - CAST(ceil(cast(0.2 as double) * n) AS BIGINT)
             THEN 'train' ELSE 'test' END AS split
      FROM (SELECT {order}, row_number() OVER (ORDER BY {at}, {order}) AS pos, count(*) OVER () AS n FROM {source})"""


# ----------------------------------------------------------------------- encoders


def customers(spark, sf):
    """Customers with a hash split; categories are learned on the train part only."""
    table = derived.table(spark, sf, "customer")
    return splitting.hash_split(table, "c_custkey").select("c_custkey", "c_mktsegment", "c_acctbal", "split")


def train_without(df, hidden):
    """Train rows of all but one segment, so that segment is unseen when encoding."""
    return df.where((F.col("split") == "train") & (F.col("c_mktsegment") != hidden))


def ordinal_encode(spark, sf):
    df = customers(spark, sf)
    codes = prep.fit_categories(train_without(df, "FURNITURE"), ["c_mktsegment"])
    return prep.ordinal_encode(df, codes, ["c_mktsegment"]).select("c_custkey", "split", "c_mktsegment")


def ordinal_categories(spark, sf):
    """Codes of a column with very many categories, numbered by a distributed sort."""
    return prep.fit_categories(customers(spark, sf).select(
        F.col("c_custkey").cast("string").alias("key")), ["key"])


def onehot_encode(spark, sf):
    df = customers(spark, sf)
    codes = prep.fit_categories(train_without(df, "FURNITURE"), ["c_mktsegment"])
    return prep.onehot_encode(df, codes, ["c_mktsegment"]).drop("c_acctbal")


def onehot_sparse(spark, sf):
    """As many categories as train customers, beside the segments."""
    df = customers(spark, sf).withColumn("key", F.col("c_custkey").cast("string"))
    codes = materialize(prep.fit_categories(train_without(df, "FURNITURE"), ["c_mktsegment", "key"]))
    return prep.onehot_sparse(df, codes, ["c_mktsegment", "key"]).select(
        "c_custkey", F.col("onehot.size").alias("size"), F.array_join("onehot.indices", ",").alias("indices"))


CUSTOMERS = f"c AS (SELECT c_custkey, c_mktsegment, c_acctbal, {split_of('c_custkey')} AS split FROM customer)"
CODES = ("k AS (SELECT c_mktsegment AS seg, row_number() OVER (ORDER BY c_mktsegment) - 1 AS code FROM"
         " (SELECT DISTINCT c_mktsegment FROM c WHERE split = 'train' AND c_mktsegment <> 'FURNITURE'))")
SEGMENTS = ["BUILDING", "HOUSEHOLD", "MACHINERY"]  # AUTOMOBILE comes first and is dropped

# ------------------------------------------------------------- imputation, scaling


def impute_input(spark, sf):
    """Trips with missing latitudes, before any row is quarantined."""
    trips = derived.trips(spark, sf).select("row_ord", "trip_id", "pickup_lat", "passenger_count")
    return splitting.hash_split(trips, "row_ord")


def median_impute(spark, sf):
    df = impute_input(spark, sf)
    medians = prep.fit_medians(df.where(F.col("split") == "train"), ["pickup_lat", "passenger_count"])
    return prep.impute(df, medians).select("row_ord", "pickup_lat", "passenger_count")


IMPUTE_SQL = using("trips", f"""
WITH s AS (SELECT row_ord, pickup_lat, passenger_count, {split_of('row_ord')} AS split FROM trips),
m AS (SELECT median(pickup_lat) AS lat, median(passenger_count) AS pax FROM s WHERE split = 'train')
SELECT row_ord, coalesce(pickup_lat, lat) AS pickup_lat, coalesce(cast(passenger_count as double), pax) AS passenger_count
FROM s, m""")

SCALED = ["l_quantity", "l_extendedprice"]


def scaling(kind):
    def query(spark, sf):
        table = stored_lines(spark, sf, "l_orderkey", "l_partkey", "l_linenumber", *SCALED)
        split = splitting.hash_split(table, "l_orderkey")
        fitted = prep.fit_scaler(split.where(F.col("split") == "train"), SCALED, kind)
        scaled = prep.scale(split, fitted)
        return scaled.select(
            "l_orderkey", "l_partkey", "l_linenumber", "split", *[F.round(c, 6).alias(c) for c in SCALED]
        )

    return query


def scale_sql(centre: str, width: str) -> str:
    stats = ", ".join(f"{centre.format(c=c)} AS m_{c}, {width.format(c=c)} AS w_{c}" for c in SCALED)
    cells = ", ".join(f"round(({c} - m_{c}) / w_{c}, 6) AS {c}" for c in SCALED)
    return f"""
      WITH s AS (SELECT *, {split_of('l_orderkey')} AS split FROM lineitem),
      m AS (SELECT {stats} FROM s WHERE split = 'train')
      SELECT l_orderkey, l_partkey, l_linenumber, split, {cells} FROM s, m"""


def location_bins(spark, sf):
    table, _ = first_generation.split_and_bin(stored_clean(spark, sf))
    return table.select("row_ord", "split", *[f"{c}_bin" for c in COORDINATES])


def bins_sql() -> str:
    ranges = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in COORDINATES)

    def bin_of(c: str) -> str:
        inner = " + ".join(f"CAST({c} > lo_{c} + {i} * ((hi_{c} - lo_{c}) / 10) AS INTEGER)" for i in range(1, 10))
        return f"CAST({inner} AS INTEGER) AS {c}_bin"

    return using("flagged", f"""
      WITH s AS (SELECT c.*, t.split FROM clean c JOIN ({time_sql('pickup_datetime', 'row_ord', 'clean')}) t USING (row_ord)),
      m AS (SELECT {ranges} FROM s WHERE split = 'train')
      SELECT row_ord, split, {', '.join(bin_of(c) for c in COORDINATES)} FROM s, m""")


def prepared_dataset(spark, sf):
    """All preparation steps on enriched trips: mean and deviation of every scaled feature
    per split; the train part must come out centred with unit spread."""
    table, fitted = prepare.prepare(stored_enriched(spark, sf))
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in fitted.feature_names]
    return table.select("split", F.inline(F.array(*pairs))).groupBy("split", "feature").agg(
        F.count("value").alias("n_rows"), F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_pop("value"), 6).alias("std"))


def prepared_sql() -> str:
    from tripkit.schema import FEATURE_ORDER

    stats = ", ".join(
        f"avg(cast({c} as double)) FILTER (split = 'train') AS m_{c},"
        f" stddev_pop(cast({c} as double)) FILTER (split = 'train') AS w_{c}" for c in FEATURE_ORDER)
    one = "\nUNION ALL ".join(
        f"""SELECT split, '{c}' AS feature, count(*) AS n_rows,
            round(avg((cast({c} as double) - m_{c}) / coalesce(nullif(w_{c}, 0), 1)), 6) + 0 AS mean,
            round(stddev_pop((cast({c} as double) - m_{c}) / coalesce(nullif(w_{c}, 0), 1)), 6) AS std
            FROM s, m GROUP BY split""" for c in FEATURE_ORDER)
    return using("features", f"""
      WITH s AS (SELECT *, {split_of('trip_id')} AS split FROM features),
      m AS (SELECT {stats} FROM s) {one}""")


def row_hashes(spark, sf):
    return derived.table(spark, sf, "lineitem").groupBy(
        (hash_column(F.col("l_orderkey"), 42) % 100).alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"))


QUERIES = {
    "row_hashes": (row_hashes, f"""
        SELECT {row_hash('l_orderkey')} % 100 AS bucket, count(*) AS n_rows FROM lineitem GROUP BY 1"""),
    "qcut_strata": (qcut_strata, using("flagged", f"""
        WITH e AS ({EDGES}) SELECT row_ord, {STRATUM} AS stratum FROM clean, e""")),
    "qcut_strata_tied": (qcut_strata_tied, f"""
        WITH clean AS (SELECT l_quantity AS eta_minutes FROM lineitem), e AS ({EDGES})
        SELECT eta_minutes AS l_quantity, {STRATUM} AS stratum, count(*) AS n_rows FROM clean, e GROUP BY 1, 2"""),
    "stratified_split": (stratified_split, using("flagged", f"""
        WITH e AS ({EDGES}) SELECT {STRATUM} AS stratum, {split_of('trip_id')} AS split, count(*) AS n_rows,
               round(sum(eta_minutes), 4) AS total FROM clean, e GROUP BY 1, 2""")),
    "stratified_split_exact": (stratified_split_exact, EXACT_SQL),
    "split_sizes": (split_sizes, SIZES_SQL),
    "split_cover": (split_cover, COVER_SQL),
    "hash_split": (hash_split, using("trips", f"SELECT row_ord, {split_of('trip_id')} AS split FROM trips")),
    "time_split": (time_split, using("flagged", time_sql("pickup_datetime", "row_ord", "clean"))),
    "time_split_tied": (time_split_tied, time_sql("o_orderdate", "o_orderkey", "orders")),
    "ordinal_encode": (ordinal_encode, f"""
        WITH {CUSTOMERS}, {CODES} SELECT c_custkey, split, coalesce(cast(code as double), -1) AS c_mktsegment
        FROM c LEFT JOIN k ON seg = c_mktsegment"""),
    "ordinal_categories": (ordinal_categories, """
        SELECT 'key' AS "column", CAST(c_custkey AS VARCHAR) AS category,
               CAST(row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1 AS INTEGER) AS code FROM customer"""),
    "onehot_encode": (onehot_encode, f"""
        WITH {CUSTOMERS} SELECT c_custkey, split,
          {', '.join(f"cast(c_mktsegment = '{s}' as double) AS c_mktsegment_{s}" for s in SEGMENTS)} FROM c"""),
    "onehot_sparse": (onehot_sparse, f"""
        WITH {CUSTOMERS}, t AS (SELECT c_custkey, c_mktsegment FROM c WHERE split = 'train' AND c_mktsegment <> 'FURNITURE'),
        s AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 2 AS i FROM (SELECT DISTINCT c_mktsegment FROM t)),
        k AS (SELECT c_custkey, row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 2 AS i FROM t),
        n AS (SELECT (SELECT count(*) - 1 FROM s) AS a, (SELECT count(*) - 1 FROM k) AS b)
        SELECT c.c_custkey, CAST(a + b AS INTEGER) AS size,
               concat_ws(',', CASE WHEN s.i >= 0 THEN s.i END, CASE WHEN k.i >= 0 THEN a + k.i END) AS indices
        FROM c CROSS JOIN n LEFT JOIN s ON s.c_mktsegment = c.c_mktsegment LEFT JOIN k ON k.c_custkey = c.c_custkey"""),
    "median_impute": (median_impute, IMPUTE_SQL),
    "standard_scale": (scaling("standard"), scale_sql("avg({c})", "stddev_pop({c})")),
    "minmax_scale": (scaling("minmax"), scale_sql("min({c})", "(max({c}) - min({c}))")),
    "robust_scale": (scaling("robust"), scale_sql(
        "median({c})", "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))")),
    "location_bins": (location_bins, bins_sql()),
    "prepared_dataset": (prepared_dataset, prepared_sql()),
}
