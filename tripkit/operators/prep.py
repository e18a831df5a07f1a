"""Encoders, imputation, scalers and location bins: fitted on train, applied everywhere."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkit.operators.lookup import lookup_join
from tripkit.operators.ordering import numbered
from tripkit.operators.selection import exact_medians, exact_quantiles, per_column

ENCODERS = ("ordinal", "onehot")
SCALERS = ("standard", "minmax", "robust")


def choose(kind: str, options: Sequence[str], what: str) -> str:
    if kind not in options:
        raise ValueError(f"unknown {what} '{kind}', choose from {list(options)}")
    return kind


# ---------------------------------------------------------------------- encoders


def fit_categories(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, category, code): codes follow the sort order of a column's categories.

    The distinct categories are dealt out by range, sorted within partitions, and numbered by
    one count per partition, so no column's categories meet in one task.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in columns]
    distinct = (
        train.select(F.inline(F.array(*pairs))).where(F.col("category").isNotNull()).distinct()
    )
    overall = numbered(distinct, "column", "category")
    first = overall.groupBy("column").agg(F.min("_pos").alias("first"))  # a row per encoded column
    return overall.join(F.broadcast(first), "column").select(
        "column", "category", (F.col("_pos") - F.col("first")).cast("int").alias("code")
    )


def ordinal_encode(df: DataFrame, categories: DataFrame, columns: Sequence[str], unseen: float = -1.0) -> DataFrame:
    """Replace each category by its code as a double; unseen and null become ``unseen``."""
    order = df.columns
    for c in columns:
        codes = categories.where(F.col("column") == c).select(
            F.col("category").alias("__category"), F.col("code").alias("__code")
        )
        keyed = df.withColumn("__category", F.col(c).cast("string"))
        joined = lookup_join(keyed, codes, ["__category"]).drop("__category")
        df = joined.withColumn(c, F.coalesce(F.col("__code").cast("double"), F.lit(unseen))).drop("__code")
    return df.select(*order)


def onehot_names(categories: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Categories of each column but the first, in order: the columns that the encoded table has."""
    chosen = categories.where((F.col("code") > 0) & F.col("column").isin(list(columns)))
    names: dict[str, list[str]] = {c: [] for c in columns}
    for r in sorted(chosen.collect(), key=lambda r: (r["column"], r["code"])):
        names[r["column"]].append(r["category"])
    return names


def onehot_encode(df: DataFrame, categories: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``{column}_{category}`` indicators without the first category; unseen rows are all zero."""
    indicators = {
        f"{c}_{v}": F.coalesce((F.col(c).cast("string") == v), F.lit(False)).cast("double")
        for c, values in onehot_names(categories, columns).items() for v in values
    }
    return df.withColumns(indicators).drop(*columns) if indicators else df.drop(*columns)


def onehot_sizes(categories: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Number of indicators of each column: its categories but the first. One row per encoded column comes to the driver."""
    chosen = categories.where(F.col("column").isin(list(columns))).groupBy("column").agg(F.max("code").alias("size"))
    found = {r["column"]: r["size"] for r in chosen.collect()}
    return {c: found.get(c, 0) for c in columns}


def onehot_sparse(df: DataFrame, categories: DataFrame, columns: Sequence[str], name: str = "onehot") -> DataFrame:
    """The indicators of ``onehot_encode`` as one sparse vector: ``name`` with its size and the rising indices of its ones.

    The plan has one join per column however many categories it has, and a row carries at most one index per column.
    The first category, unseen ones and nulls have none. The indicator of category ``code`` of a column stands
    ``code - 1`` places behind the indicators of the columns before it.
    """
    sizes = onehot_sizes(categories, columns)
    rest = [c for c in df.columns if c not in columns and c != name]
    indices, first = [], 0
    for k, c in enumerate(columns):
        codes = categories.where((F.col("column") == c) & (F.col("code") > 0)).select(
            F.col("category").alias("__category"), (F.col("code") - 1 + first).cast("int").alias(f"__index{k}"))
        df = lookup_join(df.withColumn("__category", F.col(c).cast("string")), codes, ["__category"]).drop("__category")
        indices.append(F.col(f"__index{k}"))
        first += sizes[c]
    # array_except drops the nulls inside generated code and keeps the order
    ones = F.array_except(F.array(*indices).cast("array<int>"), F.array(F.lit(None).cast("int")))
    return df.select(*(F.col(f"`{c}`") for c in rest), F.struct(F.lit(first).alias("size"), ones.alias("indices")).alias(name))


# -------------------------------------------------------------------- imputation


def fit_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians of the train rows, for every numeric column, with or without nulls."""
    medians = exact_medians(train, list(columns))
    return {c: 0.0 if m is None else m for c, m in medians.items()}


def impute(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(v))
        for c, v in values.items()
    })


# ----------------------------------------------------------------------- scaling


def fit_scaler(
    train: DataFrame, columns: Sequence[str], kind: str = "standard"
) -> dict[str, tuple[float, float]]:
    """Per column (centre, width); a constant column gets width 1 so it scales to 0."""
    choose(kind, SCALERS, "scaler")
    if kind == "robust":
        quartiles = exact_quantiles(train, columns, [0.25, 0.5, 0.75])
        fitted = {c: (q[1], q[2] - q[0]) for (c,), q in ((k, v or [0.0] * 3) for k, v in quartiles.items())}
    else:
        low, width = (F.avg, F.stddev_pop) if kind == "standard" else (F.min, lambda x: F.max(x) - F.min(x))
        found = per_column(train, {c: F.col(c) for c in columns}, [low("_val").alias("centre"), width("_val").alias("width")])
        fitted = {c: (found[c]["centre"] or 0.0, found[c]["width"] or 0.0) if c in found else (0.0, 0.0) for c in columns}
    return {c: (centre, width if width > 0 else 1.0) for c, (centre, width) in fitted.items()}


def scaled(value: Column, centre: float, width: float) -> Column:
    return (value.cast("double") - F.lit(centre)) / F.lit(width)


def scale(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: scaled(F.col(c), *stats) for c, stats in fitted.items()})


# ----------------------------------------------------------------- location bins


def fit_bins(train: DataFrame, columns: Sequence[str], bins: int = 10) -> dict[str, list[float]]:
    """Equal-width edges over the train range; the first edge is widened by 0.1 % of the
    range so the smallest value falls inside the right-closed first bin."""
    from tripkit.operators.stats import value_ranges

    edges = {}
    for c, span in value_ranges(train, columns).items():
        if span is None:
            raise ValueError(f"column {c} has no values to bin")
        lo, hi = span
        step = (hi - lo) / bins
        edges[c] = [lo - (hi - lo) * 0.001] + [lo + i * step for i in range(1, bins)] + [hi]
    return edges


def bin_of(value: Column, edges: list[float]) -> Column:
    """0-based right-closed bin; values beyond the train range go to the end bins."""
    number = F.lit(0)
    for edge in edges[1:-1]:
        number = number + (value > edge).cast("int")
    return F.when(value.isNotNull(), number)


def apply_bins(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    return df.withColumns({f"{c}_bin": bin_of(F.col(c), e) for c, e in edges.items()})


def feature_columns(df: DataFrame, excluded: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric columns, then text columns, in table order and without the excluded ones."""
    fields = [f for f in df.schema.fields if f.name not in excluded]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, text
