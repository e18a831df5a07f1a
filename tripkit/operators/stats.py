"""Full-data exploratory statistics: counts, moments, histograms, group means, boxes.

Wide tables are turned into (column, value) rows before grouping, so partial aggregation
on the map side leaves only a few rows per task whatever the table size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkit.functions.geo import hex_cell
from tripkit.operators.selection import per_column, quantile_table, scan_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _tall(df: DataFrame, columns: Sequence[str], as_type: str, keep: Sequence[Column] = ()) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast(as_type).alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*pairs)))


def _turn(row: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One wide aggregate row named ``column|field`` to one row per column."""
    structs = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{f}`").alias(f) for f in fields]) for c in columns
    ]
    return row.select(F.inline(F.array(*structs)))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def missing_counts(df: DataFrame) -> DataFrame:
    """Nulls and NaN per column, every column in one pass."""
    row = df.agg(*[F.count_if(missing(df, c)).alias(f"{c}|n_missing") for c in df.columns])
    return _turn(row, df.columns, ["n_missing"])


def missing(df: DataFrame, c: str) -> Column:
    fractional = isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
    return F.col(c).isNull() | F.isnan(c) if fractional else F.col(c).isNull()


def column_types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def describe(
    df: DataFrame, columns: Sequence[str] | None = None, digits: int = 4
) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max per numeric column."""
    columns = list(columns or numeric_columns(df))
    moments = [f("_val").cast("double").alias(name) for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    quartiles, scanned = scan_quantiles(df, columns, [0.25, 0.5, 0.75], moments)
    rows = []
    for c in columns:
        row = scanned[c].asDict() if c in scanned else {}
        rows.append((c, row.get("n", 0), *(row.get(n) for n in ("mean", "std", "min")), *(quartiles[c] or [None] * 3), row.get("max")))
    doubles = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    schema = "column string, count bigint, " + ", ".join(f"{c} double" for c in doubles)
    return df.sparkSession.createDataFrame(rows, schema).select(
        "column", "count", *[F.round(c, digits).alias(c) for c in doubles]
    )


def describe_approximate(df: DataFrame, columns: Sequence[str] | None = None, accuracy: int = 10_000) -> DataFrame:
    """The same table in a single pass, with sketched quartiles."""
    columns = list(columns or numeric_columns(df))
    aggregates = []
    for c in columns:
        value = F.col(c).cast("double")
        quartiles = F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy)
        aggregates += [
            F.count(value).alias(f"{c}|count"), F.avg(value).alias(f"{c}|mean"),
            F.stddev_samp(value).alias(f"{c}|std"), F.min(value).alias(f"{c}|min"),
            *[F.get(quartiles, F.lit(i)).alias(f"{c}|{n}") for i, n in enumerate(("p25", "p50", "p75"))],
            F.max(value).alias(f"{c}|max"),
        ]
    return _turn(df.agg(*aggregates), columns, ["count", "mean", "std", "min", "p25", "p50", "p75", "max"])


def skewness(value: Column) -> Column:
    """Bias-corrected sample skewness; null for fewer than 3 values or a constant."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def kurtosis(value: Column) -> Column:
    """Bias-corrected excess kurtosis; null for fewer than 4 values or a constant."""
    n = F.count(value).cast("double")
    scale = F.try_divide(n - 1, (n - 2) * (n - 3))
    return F.when(n > 3, scale * ((n + 1) * F.kurtosis(value) + 6))


def shape_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    row = df.agg(*[
        fn(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))).alias(f"{c}|{name}")
        for c in columns for name, fn in (("skewness", skewness), ("kurtosis", kurtosis))
    ])
    return _turn(row, columns, ["skewness", "kurtosis"])


def _pair_sums(k: int):
    """Function for ``mapInArrow``: sums over the rows where both columns of a pair are
    known, one row per pair and task. It is built here, so that it travels to the workers
    by value and they need nothing but numpy and pyarrow."""
    i, j = np.array(list(combinations(range(k), 2)), dtype=int).reshape(-1, 2).T
    names = ["pair", "n", "sx", "sy", "sxx", "syy", "sxy"]

    def sums(batches):
        n, total, square, product = (np.zeros((k, k)) for _ in range(4))
        for batch in batches:
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            known = (~np.isnan(values)).astype(float)
            values = np.nan_to_num(values, nan=0.0)
            n += known.T @ known
            total += values.T @ known  # [i, j]: sum of i where j is known
            square += (values * values).T @ known
            product += values.T @ values
        columns = [
            np.arange(len(i), dtype=np.int32), n[i, j], total[i, j], total[j, i], square[i, j], square[j, i],
            product[i, j],
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return sums


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns over rows where both are known.

    Lower triangle only; null where a column is constant. The pair sums of a batch are a
    few matrix products, which Spark expressions would need hundreds of aggregates for;
    each task hands on one row per pair. Values are centred first to keep the digits.
    """
    columns = list(columns)
    pairs = [(columns[j], columns[i]) for i, j in combinations(range(len(columns)), 2)]
    doubles = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    found = per_column(doubles, {c: F.col(c) for c in columns}, [f("_val").alias(n) for n, f in (("mean", F.avg), ("lo", F.min), ("hi", F.max))])
    constant = [c for c in columns if c not in found or found[c]["lo"] == found[c]["hi"]]
    centred = doubles.select(*[(F.col(c) - F.lit(found[c]["mean"] or 0.0 if c in found else 0.0)).alias(c) for c in columns])
    sums = (
        centred.mapInArrow(
            _pair_sums(len(columns)),
            "pair int, n double, sx double, sy double, sxx double, syy double, sxy double",
        )
        .groupBy("pair")
        .agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    )
    x_spread, y_spread = (_spread(F.col("n"), F.col(f"s{a}"), F.col(f"s{a}{a}")) for a in ("x", "y"))
    joint = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    names = df.sparkSession.createDataFrame(
        [(i, a, b, a in constant or b in constant) for i, (a, b) in enumerate(pairs)],
        "pair int, col_a string, col_b string, constant boolean",
    )
    value = F.when(~F.col("constant"), F.try_divide(joint, F.sqrt(x_spread * y_spread)))
    # the first column of a pair (i < j) is the column of the triangle, the second its row
    return sums.join(F.broadcast(names), "pair").select("col_a", "col_b", value.alias("corr"))


def _spread(n: Column, total: Column, square: Column) -> Column:
    """Sum of squared deviations, exactly 0 where only rounding is left."""
    spread = square - F.try_divide(total * total, n)
    return F.when(spread > square * 1e-12, spread).otherwise(0.0)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each column, nulls left out, most frequent first."""
    return (
        _tall(df, columns, "string")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy("column", F.desc("n_rows"), "value")
    )


# ------------------------------------------------------------------- histograms


def value_ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float] | None]:
    """Minimum and maximum per column, one pass."""
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    found = per_column(df, value, [F.min("_val").alias("lo"), F.max("_val").alias("hi")])
    return {c: (found[c]["lo"], found[c]["hi"]) if c in found and found[c]["lo"] is not None else None for c in columns}


def bin_number(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0-based equal-width bin, last bin closed on the right; null outside [lo, hi].

    A constant column gets a range of one around it, as plotting libraries do.
    """
    low = F.when(lo == hi, lo - 0.5).otherwise(lo)
    width = F.when(lo == hi, 1.0).otherwise(hi - lo)
    position = F.floor((value - low) * float(bins) / width)
    return F.when((value >= lo) & (value <= hi), F.least(position, F.lit(bins - 1)).cast("int"))


def histogram(
    df: DataFrame,
    columns: Sequence[str],
    bins: int,
    ranges: dict[str, tuple[float, float] | None] | None = None,
) -> DataFrame:
    """Rows per equal-width bin for many columns: (column, bin, bin_low, bin_high, n_rows).

    Empty bins are left out. ``ranges`` fixes the edges, e.g. to those of a baseline.
    """
    ranges = value_ranges(df, columns) if ranges is None else ranges
    known = [c for c in columns if ranges.get(c)]
    if not known:
        return df.sparkSession.createDataFrame(
            [], "column string, bin int, bin_low double, bin_high double, n_rows bigint"
        )
    # numbers of columns and bins as keys: no string is built or hashed per value
    tall = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in known])).alias("_of", "_val"))
    lo, hi = (F.get(F.array(*[F.lit(float(ranges[c][end])) for c in known]), "_of") for end in (0, 1))
    counted = (
        tall.select("_of", bin_number(F.col("_val"), lo, hi, bins).alias("bin"))
        .where(F.col("bin").isNotNull())
        .groupBy("_of", "bin")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.get(F.array(*[F.lit(c) for c in known]), "_of").alias("column"), "bin", "n_rows")
    )
    return with_edges(counted, {c: ranges[c] for c in known}, bins)


def with_edges(counted: DataFrame, ranges: dict[str, tuple[float, float] | None], bins: int) -> DataFrame:
    """(column, bin, n_rows) with the edges of the bins."""
    edges = []
    for c, span in ranges.items():
        if span:
            lo, hi = span if span[0] != span[1] else padded(*span)
            edges.append((c, lo, (hi - lo) / bins))
    table = counted.sparkSession.createDataFrame(edges, "column string, lo double, width double")
    return counted.join(F.broadcast(table), "column").select(
        "column", "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_high"),
        "n_rows",
    )


def log_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    return histogram(df.select(F.log1p(column).alias(f"log1p_{column}")), [f"log1p_{column}"], bins)


# ------------------------------------------------------------------ group means


def mean_by(df: DataFrame, key: Column, name: str, target: str) -> DataFrame:
    value = F.nanvl(F.col(target).cast("double"), F.lit(None).cast("double"))
    return df.groupBy(key.alias(name)).agg(F.avg(value).alias("mean_target"), F.count(value).alias("n_rows"))


# ----------------------------------------------------------------- box and grids


def box_statistics(
    df: DataFrame, key: str, value: str, reach: float = 1.5
) -> DataFrame:
    """Quartiles, whiskers and outliers of ``value`` per group of ``key``, however many there are.

    Whiskers are the most extreme values within ``reach`` inter-quartile ranges of the box.
    """
    q1, median, q3 = (F.get("_q", F.lit(k)) for k in range(3))
    fences = quantile_table(df, [value], [0.25, 0.5, 0.75], by=[key]).select(
        F.col("_k0").alias("__group"), q1.alias("q1"), median.alias("median"), q3.alias("q3"),
        (q1 - reach * (q3 - q1)).alias("__low"), (q3 + reach * (q3 - q1)).alias("__high"))
    x = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    inside = x.between(F.col("__low"), F.col("__high"))
    return (
        df.where(x.isNotNull())
        .join(fences, F.col(key).eqNullSafe(F.col("__group")))
        .groupBy(key, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n_rows"),
        )
    )


def hex_density(df: DataFrame, x: str, y: str, columns: int = 50, min_count: int = 1) -> DataFrame:
    """Rows per hexagonal cell with the cell centre, cells below ``min_count`` left out."""
    ranges = value_ranges(df, [x, y])
    if not (ranges[x] and ranges[y]):
        return df.sparkSession.createDataFrame(
            [], "lattice int, cell_x bigint, cell_y bigint, n_rows bigint, center_x double, center_y double"
        )
    (x0, x1), (y0, y1) = (padded(*ranges[c]) for c in (x, y))
    lattice, col, row = hex_cell(F.col(x), F.col(y), (x0, x1), (y0, y1), columns)
    cells = (
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(lattice.alias("lattice"), col.alias("cell_x"), row.alias("cell_y"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") >= min_count)
    )
    return with_centres(cells, (x0, x1), (y0, y1), columns)


def with_centres(cells: DataFrame, x_range: tuple[float, float], y_range: tuple[float, float], columns: int) -> DataFrame:
    """Hexagonal cells with their centres."""
    (x0, x1), (y0, y1) = x_range, y_range
    half, rows = F.col("lattice") / 2.0, int(columns / math.sqrt(3))
    return cells.withColumn("center_x", F.lit(x0) + (F.col("cell_x") + half) * ((x1 - x0) / columns)).withColumn(
        "center_y", F.lit(y0) + (F.col("cell_y") + half) * ((y1 - y0) / rows))


def padded(lo: float, hi: float) -> tuple[float, float]:
    return (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)


def grid_counts(df: DataFrame, group: str, x: str, y: str, x_step: float, y_step: float) -> DataFrame:
    """Two-dimensional bin counts, per value of a grouping flag; rows without both values are left out."""
    return (
        df.where(~missing(df, x) & ~missing(df, y))
        .groupBy(
            group, F.floor(F.col(x) / x_step).alias("x_bin"), F.floor(F.col(y) / y_step).alias("y_bin")
        )
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
