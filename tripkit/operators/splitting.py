"""Train / validation / test splits: by strata, by hash, by time.

The exact modes need the k-th smallest row hash of each stratum. It is found with ``ranked_table``, so no stratum
(a fifth of all rows) is ever sorted in one task. Strata, their quotas and their cut points are tables, joined to
the rows at the end, however many strata there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.functions.keys import row_hash, row_uniform
from tripkit.operators.lookup import lookup_join
from tripkit.operators.ordering import numbered
from tripkit.operators.selection import exact_quantiles, group_ranges, ranked_table, ranges_table, select_ranks
from tripkit.schema import ROW_ORDER, SEED, TARGET, TEST_SIZE, VAL_SIZE

LAST = 2**63 - 1  # an input order no row exceeds


# ------------------------------------------------------------------------ strata


def quantile_edges(df: DataFrame, column: str, q: int = 5) -> list[float]:
    """Distinct quantile edges of a column, linear interpolation."""
    edges = exact_quantiles(df, [column], [i / q for i in range(q + 1)])[(column,)]
    return sorted(set(edges or []))


def stratum_of(value: Column, edges: list[float]) -> Column:
    """Bin number with bins (a, b], the lowest value included; null for a null value."""
    number = F.lit(0)
    for edge in edges[1:-1]:
        number = number + (value > edge).cast("int")
    return F.when(value.isNotNull(), number)


def add_strata(df: DataFrame, column: str = TARGET, q: int = 5) -> DataFrame:
    return df.withColumn("stratum", stratum_of(F.col(column), quantile_edges(df, column, q)))


# ------------------------------------------------------------------------- sizes


def split_sizes(n: int, test_size: float = TEST_SIZE, val_size: float = VAL_SIZE) -> dict[str, int]:
    """Published rounding: test is rounded up first, then validation from the rest."""
    n_test = math.ceil(test_size * n)
    rest = n - n_test
    n_val = math.ceil(val_size / (1.0 - test_size) * rest)
    return {"train": rest - n_val, "val": n_val, "test": n_test}


def proportional(counts: DataFrame, rows: str, total: int, take: int, share: str) -> DataFrame:
    """Integer shares of ``take`` proportional to the column ``rows``, which adds up to ``total``: largest remainder
    first, equal ones by stratum. ``counts`` has one row per ``stratum``; they are ranked by a distributed sort."""
    product = F.col(rows).cast("decimal(18,0)") * F.lit(take).cast("decimal(18,0)")  # beyond 64 bits for 10^10 rows
    divided = counts.withColumn("__product", product).withColumns({
        share: F.expr(f"__product div {total}"), "__rest": F.expr(f"CAST(__product % {total} AS BIGINT)")}).drop("__product")
    ranked = numbered(divided, F.desc("__rest"), F.col("stratum"))
    left = take - ranked.agg(F.sum(share)).first()[0]
    return ranked.withColumn(share, F.col(share) + (F.col("_pos") < left).cast("bigint")).drop("__rest", "_pos")


def stratum_quotas(counts: DataFrame, total: int, test_size: float, val_size: float) -> DataFrame:
    """(stratum, n_test, n_val): rows of each stratum that go to test and to validation.

    ``counts`` (stratum, n) has one row per stratum, whatever their number; their n add up to ``total``.
    """
    sizes = split_sizes(total, test_size, val_size)
    kept = proportional(counts, "n", total, sizes["train"] + sizes["val"], "kept")
    train = proportional(kept, "kept", sizes["train"] + sizes["val"], sizes["train"], "train") if sizes["train"] else (
        kept.withColumn("train", F.lit(0).cast("bigint")))
    return train.select("stratum", (F.col("n") - F.col("kept")).alias("n_test"), (F.col("kept") - F.col("train")).alias("n_val"))


# ------------------------------------------------------------------------ splits


def hash_split(
    df: DataFrame, key: str, test_size: float = TEST_SIZE, val_size: float = VAL_SIZE, seed: int = SEED
) -> DataFrame:
    """Independent assignment by row hash: map-only, stable when rows are added.

    The hash does not depend on the stratum, so every stratum is divided in the same
    proportions up to sampling noise; use ``exact_split`` for exact sizes. Rows of one key
    stay together, so a key that is not unique cannot leak from train into test.
    """
    u = row_uniform(F.col(key), seed)
    return df.withColumn(
        "split", F.when(u < test_size, "test").when(u < test_size + val_size, "val").otherwise("train")
    )


def exact_split(
    df: DataFrame,
    key: str,
    stratum: str = "stratum",
    order: str = ROW_ORDER,
    test_size: float = TEST_SIZE,
    val_size: float = VAL_SIZE,
    seed: int = SEED
) -> DataFrame:
    """Stratified split with exact sizes: the smallest hashes of a stratum go to test,
    the next ones to validation. Equal hashes are told apart by the unique ``order``."""
    hashed = df.withColumn("__hash", row_hash(F.col(key), seed))
    ranges = ranges_table(hashed, ["__hash"], [stratum]).persist()
    total, nulls = ranges.agg(F.sum("n"), F.count_if(F.col("_k0").isNull())).first()
    if nulls:
        raise ValueError(f"column {stratum} holds nulls")
    if not total:
        return df.withColumn("split", F.lit("train"))
    quotas = stratum_quotas(ranges.select(F.col("_k0").alias("stratum"), "n"), total, test_size, val_size)
    ends = quotas.select(F.col("stratum").alias("_k0"), F.posexplode(
        F.array("n_test", F.col("n_test") + F.col("n_val"))).alias("_number", "_end"))
    cuts = _last_positions(hashed, stratum, order, ends, ranges).withColumnRenamed("_k0", stratum)
    position = _position(F.col("__hash"), F.col(order))
    split = F.when(position <= F.col("__cut0"), "test").when(position <= F.col("__cut1"), "val").otherwise("train")
    return lookup_join(hashed, cuts, [stratum]).withColumn("split", split).drop("__hash", "__cut0", "__cut1")


def _position(major: Column, minor: Column) -> Column:
    """Two-part sort position; structs compare field by field."""
    return F.struct(major.cast("bigint").alias("major"), minor.cast("bigint").alias("minor"))


def _last_positions(df: DataFrame, stratum: str, order: str, ends: DataFrame, ranges: DataFrame) -> DataFrame:
    """(_k0, __cut0, __cut1): per stratum the position of the last row before each end, below every row where that is 0.

    ``ends`` (_k0, _number, _end) counts rows of the stratum from the smallest hash on.
    """
    wanted = ends.where("_end > 0").select("_k0", F.lit("__hash").alias("_col"), (F.col("_end") - 1).alias("_rank")).distinct()
    found = ranked_table(df, ["__hash"], wanted, ranges, [stratum]).select(
        "_k0", "_rank", F.col("value").alias("_hash"), "below", "equal")
    # where several rows share the hash at an end, their input order decides
    shared = found.where("equal > 1").select("_k0", F.col("_hash").alias("_k1"), (F.col("_rank") - F.col("below")).alias("_rank"))
    last = found.withColumn("_tie", F.lit(LAST))
    if not shared.isEmpty():
        by = [stratum, "__hash"]
        ties = lookup_join(df.select(*by, order), shared.select(F.col("_k0").alias(stratum), F.col("_k1").alias("__hash")).distinct(), by, "inner")
        places = ranked_table(ties, [order], shared.withColumn("_col", F.lit(order)), ranges_table(ties, [order], by).persist(), by)
        named = places.select(F.col("_k0").alias("_s"), F.col("_k1").alias("_h"), F.col("_rank").alias("_r"), F.col("value").alias("_place"))
        at = (F.col("_k0") == F.col("_s")) & (F.col("_hash") == F.col("_h")) & (F.col("_rank") - F.col("below") == F.col("_r"))
        last = found.join(named, at, "left").withColumn("_tie", F.coalesce("_place", F.lit(LAST)))
    held = last.select(F.col("_k0").alias("_s"), F.col("_rank").alias("_r"), _position(F.col("_hash"), F.col("_tie")).alias("_cut"))
    placed = ends.join(held, (F.col("_k0") == F.col("_s")) & (F.col("_end") - 1 == F.col("_r")), "left")
    cut = F.coalesce("_cut", _position(F.lit(-1), F.lit(0)))
    return placed.groupBy("_k0").agg(*(F.max(F.when(F.col("_number") == k, cut)).alias(f"__cut{k}") for k in (0, 1)))


def time_split(
    df: DataFrame,
    at: str = "pickup_datetime",
    order: str = ROW_ORDER,
    test_size: float = TEST_SIZE
) -> DataFrame:
    """Oldest rows to train, the newest ``test_size`` to test; equal times in input order."""
    stamped = df.withColumn("__at", _micros(df, at))
    ranges = group_ranges(stamped, ["__at"])
    if not ranges:
        return df.withColumn("split", F.lit("train"))
    n = ranges["__at",]["n"]
    n_train = n - math.ceil(test_size * n)
    if n_train == 0:
        return df.withColumn("split", F.lit("test"))
    key = ("__at",)
    f = select_ranks(stamped, ["__at"], {key: [n_train - 1]}, ranges, ())[key, n_train - 1]
    last_order = LAST
    if f.equal > 1:
        ties = stamped.where(F.col("__at") == F.lit(f.value))
        rank = n_train - 1 - f.below
        tie_ranges = group_ranges(ties, [order])
        last_order = select_ranks(ties, [order], {(order,): [rank]}, tie_ranges, ())[(order,), rank].value
    position = _position(F.col("__at"), F.col(order))
    cut = _position(F.lit(f.value), F.lit(last_order))
    return stamped.withColumn("split", F.when(position <= cut, "train").otherwise("test")).drop("__at")


def _micros(df: DataFrame, at: str) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, independent of the session zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, F.col(at).cast("timestamp_ntz"))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def split_cover(df: DataFrame, split: DataFrame, key: str = ROW_ORDER) -> DataFrame:
    """(split, n_keys, n_shared, n_foreign): keys of each part, how many of them other parts hold too, and how many are
    not in ``df``; keys of ``df`` that no part holds stand under a null split. A disjoint cover has neither.

    A key is gathered as counts and the names of its parts, so that one key may hold any number of rows.
    """
    given = df.select(F.col(key).alias("_key"), F.lit(None).cast("string").alias("split"), F.lit(1).alias("_given"))
    found = split.select(F.col(key).alias("_key"), "split", F.lit(0).alias("_given"))
    keys = given.unionByName(found).groupBy("_key").agg(F.max("_given").alias("_given"), F.collect_set("split").alias("_parts"))
    return keys.select("_given", "_parts", F.explode_outer("_parts").alias("split")).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_if(F.size("_parts") > 1).alias("n_shared"), F.count_if(F.col("_given") == 0).alias("n_foreign"))
