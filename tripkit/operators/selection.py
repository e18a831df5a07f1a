"""Exact order statistics that never gather a column, or a group, into one task.

A first scan takes counts, ends and a mergeable quantile sketch of every column, whose error bound
brackets each wanted quantile between two values. Each further pass cuts the open range of every wanted
rank into equal steps, counts the rows per step on the map side, and keeps the one step that holds the
rank. What lies below and above a bracket is counted too, so the pass proves the rank, and a bracket that
failed only costs another pass. A step shrinks to the smallest and largest value really inside it, so
ties, outliers and hot values end the search early instead of growing a task.

There is one way for every size of table. Columns without groups follow from parameters: the driver holds
their ranges, and a pass is one job that hands it a bounded number of counters. Groups come from the data:
their ranges are tables, persisted from pass to pass. Infinite values stand at the ends and are counted only.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Equal steps of a range.
STEPS = 2048
#: Size of the sketches, and the share of rows by which a bracket reaches beyond its quantile: twice the error that
#: sketches of that size exceed once in a hundred times.
SKETCH, REACH = 1000, 0.006


@dataclass(frozen=True)
class Found:
    """The value at a rank, how many rows are below it and how many equal it."""

    value: Any
    below: int
    equal: int


def _key_names(by: Sequence[str]) -> list[str]:
    return [f"_k{i}" for i in range(len(by))] + ["_col"]


def _all_integral(df: DataFrame, columns: Sequence[str]) -> bool:
    return all(isinstance(df.schema[c].dataType, T.IntegralType) for c in columns)


def _plain(c: str, integral: bool) -> Column:
    """The value as bigint or double, NaN as null."""
    if integral:
        return F.col(c).cast("bigint")
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def per_column(df: DataFrame, values: dict[str, Column], aggregates: Sequence[Column]) -> dict[str, Row]:
    """The row of ``aggregates`` of _val for each column, one pass; columns of an empty table have none.

    Columns become rows under their numbers: an aggregate of its own per column is code too long for the JVM to
    compile once there are a few dozen. A row per column comes to the driver.
    """
    tall = df.select(F.posexplode(F.array(*[v.cast("double") for v in values.values()])).alias("_of", "_val"))
    rows = {r["_of"]: r for r in tall.groupBy("_of").agg(*aggregates).collect()} if values else {}
    return {c: rows[k] for k, c in enumerate(values) if k in rows}


def _is_finite(value: Column, integral: bool) -> Column:
    return value.isNotNull() if integral else F.abs(value) < float("inf")


def _long_form(df: DataFrame, columns: Sequence[str], by: Sequence[str], integral: bool) -> DataFrame:
    """One row per group key, column name and known value, as bigint if all columns are."""
    keys = [F.col(c).alias(k) for c, k in zip(by, _key_names(by))]
    if len(columns) == 1:
        tall = df.select(*keys, F.lit(columns[0]).alias("_col"), _plain(columns[0], integral).alias("_val"))
    else:
        pairs = [F.struct(F.lit(c).alias("_col"), _plain(c, integral).alias("_val")) for c in columns]
        tall = df.select(*keys, F.inline(F.array(*pairs)))
    return tall.where("_val IS NOT NULL")


def _summary(integral: bool, probabilities: Sequence[float] = ()) -> list[Column]:
    """n, neg and pos infinite values, lo and hi of the finite ones of _val, as aggregates.

    With ``probabilities`` also ``brackets``: two values for each, one after the other, between which a
    sketch of the finite values has the quantile.
    """
    value = F.col("_val")
    finite = F.when(_is_finite(value, integral), value)
    infinite = [F.lit(0).cast("bigint")] * 2 if integral else [F.count_if(value == s * float("inf")) for s in (-1, 1)]
    found = [F.count(value).alias("n"), infinite[0].alias("neg"), infinite[1].alias("pos"), F.min(finite).alias("lo"), F.max(finite).alias("hi")]
    if probabilities:
        kind = "bigint" if integral else "double"
        sketch = getattr(F, f"kll_sketch_agg_{kind}")(finite, F.lit(SKETCH))
        ends = F.array(*(F.lit(min(max(p + s * REACH, 0.0), 1.0)) for p in probabilities for s in (-1, 1)))
        between = getattr(F, f"kll_sketch_get_quantile_{kind}")(sketch, ends)
        # among few values neighbouring ranks lie further apart than the reach
        wide = F.flatten(F.array_repeat(F.array(F.min(finite), F.max(finite)), len(probabilities)))
        found.append(F.when(F.count(finite) > int(2 / REACH), between).when(F.count(finite) > 0, wide).alias("brackets"))
    return found


def ranges_table(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), probabilities: Sequence[float] = ()) -> DataFrame:
    """Per group and column that has values: n, neg and pos infinite ones, lo and hi of the finite ones.

    With ``probabilities`` also ``brackets``, in their order.
    """
    integral = _all_integral(df, columns)
    return _long_form(df, columns, by, integral).groupBy(*_key_names(by)).agg(*_summary(integral, probabilities))


def group_ranges(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> dict[tuple, dict]:
    """``ranges_table`` on the driver, keyed (group..., column); for groups that are known to be few."""
    keys = _key_names(by)
    return {tuple(r[k] for k in keys): {name: r[name] for name in ("n", "neg", "pos", "lo", "hi")}
            for r in ranges_table(df, columns, by).collect()}


def _on(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, Column]:
    """``right`` with its keys prefixed _t, and the condition that they equal ``left``'s, nulls included."""
    renamed = right.withColumnsRenamed({k: f"_t{k}" for k in keys})
    condition = F.col("_col") == F.col("_t_col")
    for k in keys[:-1]:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_t{k}"))
    return renamed, condition


def _step_number(integral: bool) -> Column:
    """Which of the equal steps between ``_lo`` and ``_hi`` holds ``_val``; monotone."""
    if integral:
        width = f"((_hi div {STEPS}) - (_lo div {STEPS}) + 1)"
        return F.expr(f"(_val div {width}) - (_lo div {width})")
    width = F.col("_hi") / float(STEPS) - F.col("_lo") / float(STEPS)
    position = F.floor(F.try_divide(F.col("_val") - F.col("_lo"), width))
    # differences beyond the largest double are halved first
    wide = F.floor(F.try_divide(F.col("_val") / 2.0 - F.col("_lo") / 2.0, width / 2.0))
    position = F.when(F.abs(F.col("_val") - F.col("_lo")) < float("inf"), position).otherwise(wide)
    return F.coalesce(position, (F.col("_val") > F.col("_lo")).cast("bigint"))


def _step(integral: bool) -> Column:
    """The step, or one before or behind all of them for a value outside of its range."""
    return F.when(F.col("_val") < F.col("_lo"), -1).when(F.col("_val") > F.col("_hi"), STEPS + 2).otherwise(_step_number(integral))


def ranked_table(df: DataFrame, columns: Sequence[str], wanted: DataFrame, ranges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(keys, _col, _rank, value, below, equal) for each zero-based rank of ``wanted`` (keys, _col, _rank).

    ``wanted`` may bring a bracket (_from, _to) of its rank. The result is persisted; it is small beside ``df``.
    """
    bracketed = "_from" in wanted.columns
    keys, integral = _key_names(by), _all_integral(df, columns)
    kind = "bigint" if integral else "double"
    spans, same = _on(wanted, ranges, keys)
    at = wanted.join(spans, same)
    result = ["_rank", F.col("value").cast(kind).alias("value"), "below", "equal"]
    ended = at.select(*keys, "_rank", F.expr(
        "CASE WHEN _rank < neg THEN named_struct('value', double('-Infinity'), 'below', 0L, 'equal', neg)"
        " WHEN _rank >= n - pos THEN named_struct('value', double('Infinity'), 'below', n - pos, 'equal', pos) END").alias("_end"))
    done = [] if integral else [ended.where("_end IS NOT NULL").select(*keys, "_rank", "_end.*").select(*keys, *result)]
    left = at.where("_rank >= neg AND _rank < n - pos").select(
        *keys, "_rank", *([F.col("_from").alias("_lo"), F.col("_to").alias("_hi")] if bracketed else [F.col("lo").alias("_lo"), F.col("hi").alias("_hi")]),
        F.col("neg").alias("_base"), (F.col("n") - F.col("neg") - F.col("pos")).alias("_inside"),
        (F.col("_from").eqNullSafe(F.col("lo")) & F.col("_to").eqNullSafe(F.col("hi")) if bracketed else F.lit(True)).alias("_sure"))
    while True:
        left = left.persist()
        done.append(left.where("_sure AND _lo = _hi").select(*keys, "_rank", F.col("_lo").alias("value"), F.col("_base").alias("below"),
                                                             F.col("_inside").alias("equal")))
        left = left.where("NOT _sure OR _lo < _hi")
        open_columns = {r["_col"] for r in left.select("_col").distinct().collect()}
        if not open_columns:
            return reduce(DataFrame.unionByName, done)
        # only columns that still have an open range are read again
        tall = _long_form(df, [c for c in columns if c in open_columns], by, integral).where(_is_finite(F.col("_val"), integral))
        spans, same = _on(tall, left.select(*keys, "_lo", "_hi", "_base", "_sure").distinct(), keys)
        # of a bracket that is not proven yet, what lies below and above are steps too
        counts = (
            tall.join(spans, same & (~F.col("_sure") | F.col("_val").between(F.col("_lo"), F.col("_hi"))))
            .groupBy(*keys, "_lo", "_hi", "_base", _step(integral).alias("_step"))
            .agg(F.count(F.lit(1)).alias("_rows"), F.min("_val").alias("_from"), F.max("_val").alias("_to"))
        )
        # at most STEPS + 3 rows per open range
        upto = Window.partitionBy(*keys, "_lo", "_hi").orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)
        before = counts.withColumn("_before", F.col("_base") + F.sum("_rows").over(upto) - F.col("_rows"))
        ranks, same = _on(before, left.select(*keys, F.col("_lo").alias("_at"), F.col("_hi").alias("_end"), "_rank"), keys)
        left = before.join(ranks, same & (F.col("_lo") == F.col("_at")) & (F.col("_hi") == F.col("_end")) & (F.col("_rank") >= F.col("_before"))
                           & (F.col("_rank") < F.col("_before") + F.col("_rows"))).select(
            *keys, "_rank", F.col("_from").alias("_lo"), F.col("_to").alias("_hi"), F.col("_before").alias("_base"),
            F.col("_rows").alias("_inside"), F.lit(True).alias("_sure"))


@dataclass(frozen=True)
class _Open:
    """A range that holds wanted ranks of a column; ``inside`` rows once that is proven."""

    column: str
    lo: Any
    hi: Any
    base: int
    inside: int | None
    ranks: tuple[int, ...]


def _narrowed(df: DataFrame, open_ranges: Iterable[_Open], integral: bool) -> dict[tuple[str, int], Found]:
    """Narrows ranges of columns, whose number follows from parameters, until each is one value."""
    kind = "bigint" if integral else "double"
    found: dict[tuple[str, int], Found] = {}
    todo = list(open_ranges)
    while True:
        for o in todo:
            if o.inside is not None and o.lo == o.hi:
                found.update({(o.column, rank): Found(o.lo, o.base, o.inside) for rank in o.ranks})
        todo = [o for o in todo if o.inside is None or o.lo != o.hi]
        if not todo:
            return found
        spans = df.sparkSession.createDataFrame([(k, o.column, o.lo, o.hi, o.inside is not None) for k, o in enumerate(todo)],
                                                f"_range int, _of string, _lo {kind}, _hi {kind}, _sure boolean")
        tall = _long_form(df, sorted({o.column for o in todo}), (), integral).where(_is_finite(F.col("_val"), integral))
        here = (F.col("_col") == F.col("_of")) & (~F.col("_sure") | F.col("_val").between(F.col("_lo"), F.col("_hi")))
        # a row per range, and STEPS + 3 rows per range at most to the driver
        counts = (tall.join(F.broadcast(spans), here).groupBy("_range", _step(integral).alias("_step"))
                  .agg(F.count(F.lit(1)).alias("rows"), F.min("_val").alias("lo"), F.max("_val").alias("hi"))
                  .toArrow().sort_by([("_range", "ascending"), ("_step", "ascending")]))
        number, rows = (np.asarray(counts.column(c)) for c in ("_range", "rows"))
        ends = [counts.column(c).to_pylist() for c in ("lo", "hi")]
        limits, before = np.searchsorted(number, np.arange(len(todo) + 1)), todo
        todo = []
        for k, o in enumerate(before):
            upto = o.base + np.cumsum(rows[limits[k] : limits[k + 1]])
            held: dict[int, list[int]] = {}
            for rank in o.ranks:
                held.setdefault(int(np.searchsorted(upto, rank, "right")), []).append(rank)
            for at, ranks in held.items():
                row = int(limits[k]) + at
                todo.append(_Open(o.column, ends[0][row], ends[1][row], int(upto[at] - rows[row]), int(rows[row]), tuple(ranks)))


def _ended(rank: int, span: dict | Row) -> Found | None:
    """A rank that an infinite value holds."""
    if rank < span["neg"]:
        return Found(-float("inf"), 0, span["neg"])
    if rank >= span["n"] - span["pos"]:
        return Found(float("inf"), span["n"] - span["pos"], span["pos"])
    return None


def select_ranks(
    df: DataFrame, columns: Sequence[str], wanted: dict[tuple, Iterable[int]], ranges: dict[tuple, dict], by: Sequence[str] = ()
) -> dict[tuple[tuple, int], Found]:
    """Value at each wanted zero-based rank, for keys the driver knows already.

    ``wanted`` and ``ranges`` (from ``group_ranges`` with the same columns) are keyed
    (group..., column); the result is keyed ((group..., column), rank).
    """
    targets = [(*key, rank) for key, ranks in wanted.items() for rank in sorted(set(ranks))]
    if not targets:
        return {}
    if not by:
        ended = {((c,), rank): end for c, rank in targets if (end := _ended(rank, ranges[(c,)]))}
        spans = {c: ranges[(c,)] for c, _ in targets}
        inner = {c: tuple(rank for own, rank in targets if own == c and ((c,), rank) not in ended) for c in spans}
        todo = [_Open(c, r["lo"], r["hi"], r["neg"], r["n"] - r["neg"] - r["pos"], inner[c]) for c, r in spans.items() if inner[c]]
        return ended | {((c,), rank): f for (c, rank), f in _narrowed(df, todo, _all_integral(df, columns)).items()}
    keys = _key_names(by)
    spark = df.sparkSession
    fields = [T.StructField(k, df.schema[c].dataType) for k, c in zip(keys, by)] + [T.StructField("_col", T.StringType())]
    value = T.LongType() if _all_integral(df, columns) else T.DoubleType()
    spans = [T.StructField(c, T.LongType()) for c in ("n", "neg", "pos")] + [T.StructField(c, value) for c in ("lo", "hi")]
    wanted_table = spark.createDataFrame(targets, T.StructType([*fields, T.StructField("_rank", T.LongType())]))
    range_table = spark.createDataFrame([(*k, r["n"], r["neg"], r["pos"], r["lo"], r["hi"]) for k, r in ranges.items()],
                                        T.StructType([*fields, *spans]))
    return {(tuple(r[k] for k in keys), r["_rank"]): Found(r["value"], r["below"], r["equal"])
            for r in ranked_table(df, columns, wanted_table, range_table, by).collect()}


def quantile_table(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(keys, _col, _q): linearly interpolated quantiles of the non-null values, per group and column."""
    keys = _key_names(by)
    ranges = ranges_table(df, columns, by, probabilities).persist()
    places = ranges.select(*keys, F.posexplode(F.array(*[F.lit(float(p)) * (F.col("n") - 1) for p in probabilities])).alias("_i", "_at"), "brackets")
    bracket = [F.get("brackets", 2 * F.col("_i") + k).alias(name) for k, name in enumerate(("_from", "_to"))]
    ends = places.select(*keys, "_i", "_at", F.floor("_at").alias("_low"), F.ceil("_at").alias("_high"), *bracket)
    wanted = ends.select(*keys, F.explode(F.array("_low", "_high")).alias("_rank"), "_from", "_to").groupBy(*keys, "_rank").agg(
        F.min("_from").alias("_from"), F.max("_to").alias("_to"))
    found = ranked_table(df, columns, wanted, ranges, by).select(*keys, "_rank", F.col("value").cast("double").alias("value"))
    for end in ("_low", "_high"):
        values, same = _on(ends, found.withColumnsRenamed({"_rank": f"{end}_rank", "value": f"{end}_value"}), keys)
        ends = ends.join(values, same & (F.col(end) == F.col(f"{end}_rank"))).drop(*[f"_t{k}" for k in keys])
    low, high = F.col("_low_value"), F.col("_high_value")
    value = F.when(low == high, low).otherwise(low + (high - low) * (F.col("_at") - F.col("_low")))
    return ends.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", value.alias("_v")))), lambda s: s["_v"]).alias("_q"))


def scan_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                   more: Sequence[Column] = ()) -> tuple[dict[str, list[float] | None], dict[str, Row]]:
    """Linearly interpolated quantiles of each column, and the row of its first scan: ``more`` aggregates of _val among others."""
    integral = _all_integral(df, columns)
    scanned = {r["_col"]: r for r in _long_form(df, columns, (), integral).groupBy("_col").agg(*_summary(integral, probabilities), *more).collect()}
    places, found, todo = {}, {}, []
    for c, span in scanned.items():
        places[c] = [float(p) * (span["n"] - 1) for p in probabilities]
        for i, at in enumerate(places[c]):
            ranks = {math.floor(at), math.ceil(at)}
            ended = {(c, r): end for r in ranks if (end := _ended(r, span))}
            found |= ended
            inner = tuple(r for r in ranks if (c, r) not in ended)
            if inner:
                lo, hi = span["brackets"][2 * i : 2 * i + 2]
                proven = (lo, hi) == (span["lo"], span["hi"])
                todo.append(_Open(c, lo, hi, span["neg"], span["n"] - span["neg"] - span["pos"] if proven else None, inner))
    found |= _narrowed(df, todo, integral)
    result: dict[str, list[float] | None] = dict.fromkeys(columns)
    for c, own in places.items():
        ends = [(float(found[c, math.floor(at)].value), float(found[c, math.ceil(at)].value), at - math.floor(at)) for at in own]
        result[c] = [low if low == high else low + (high - low) * share for low, high, share in ends]
    return result, scanned


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = ()) -> dict[tuple, list[float] | None]:
    """Quantiles on the driver, keyed (group..., column); groups must be known to be few."""
    if not by:
        return {(c,): q for c, q in scan_quantiles(df, columns, probabilities)[0].items()}
    keys = _key_names(by)
    return {tuple(r[k] for k in keys): list(r["_q"]) for r in quantile_table(df, columns, probabilities, by).collect()}


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: q and q[0] for c, q in scan_quantiles(df, columns, [0.5])[0].items()}
