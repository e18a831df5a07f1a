"""Exact order statistics against numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tripkit.operators.selection import exact_medians, exact_quantiles, group_ranges, quantile_table, select_ranks

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def columns():
    rng = np.random.default_rng(7)
    n = 5000
    return pd.DataFrame({
        "smooth": rng.normal(size=n),
        "hot": np.where(rng.random(n) < 0.4, 3.25, rng.integers(0, 9, n).astype(float)),
        "outlier": np.where(np.arange(n) == 17, 1e300, rng.random(n)),
        "both_ends": np.where(np.arange(n) == 5, -1.7e308, np.where(np.arange(n) == 6, 1.7e308, rng.random(n))),
        "close": 1e15 + rng.integers(0, 50, n) * 0.125,
        "constant": np.full(n, 4.5),
        "tiny": rng.integers(0, 20, n) * 5e-324,
        "group": rng.integers(0, 4, n),
    })


def test_quantiles_of_awkward_columns(spark):
    pdf = columns()
    names = [c for c in pdf.columns if c not in ("group", "both_ends")]
    found = exact_quantiles(spark.createDataFrame(pdf), names, PROBABILITIES)
    for c in names:
        np.testing.assert_allclose(found[(c,)], np.quantile(pdf[c], PROBABILITIES), rtol=1e-12, atol=1e-300)


def test_ranks_over_the_whole_double_range(spark):
    pdf = columns()
    df = spark.createDataFrame(pdf[["both_ends"]])
    ranges = group_ranges(df, ["both_ends"])
    ranks = [0, 1, 2500, 4998, 4999]
    found = select_ranks(df, ["both_ends"], {("both_ends",): ranks}, ranges)
    ordered = np.sort(pdf["both_ends"].to_numpy())
    assert [found[("both_ends",), r].value for r in ranks] == [ordered[r] for r in ranks]


def test_grouped_quantiles(spark):
    pdf = columns()
    found = exact_quantiles(
        spark.createDataFrame(pdf), ["smooth", "hot"], [0.25, 0.5], by=["group"]
    )
    for group, part in pdf.groupby("group"):
        for c in ("smooth", "hot"):
            np.testing.assert_allclose(found[group, c], np.quantile(part[c], [0.25, 0.5]), rtol=1e-12)


def test_integers_beyond_double_precision(spark):
    values = [-(2**63), -5, -1, 0, 1, 1, 1, 2**53 + 1, 2**53 + 2, 2**62, 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    ranges = group_ranges(df, ["v"])
    found = select_ranks(df, ["v"], {("v",): range(len(values))}, ranges)
    assert [found[("v",), r].value for r in range(len(values))] == values
    hot = found[("v",), 5]
    assert (hot.below, hot.equal) == (4, 3)


def test_null_and_nan_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (2.0,), (9.0,)], "x double")
    assert exact_medians(df, ["x"]) == {"x": 2.0}
    assert exact_medians(df, ["x"]) == {"x": 2.0}


def test_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_medians(df, ["x"]) == {"x": None}


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 5.0), (None, 7.0)], "g string, x double")
    found = exact_quantiles(df, ["x"], [0.5], by=["g"])
    assert found == {("a", "x"): [1.0], (None, "x"): [6.0]}


def test_infinite_values_are_ordered_like_any_other(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in [inf, 3.0, -inf, None, 1.0, float("nan"), inf, -1e308, 1e308]], "x double")
    found = exact_quantiles(df, ["x"], [0.0, 1 / 6, 0.5, 5 / 6, 1.0])[("x",)]
    assert found == [-inf, -1e308, 3.0, inf, inf]
    only = spark.createDataFrame([(inf,), (-inf,)], "x double")
    assert exact_quantiles(only, ["x"], [0.0, 1.0])[("x",)] == [-inf, inf]


def test_more_groups_than_a_driver_table_should_hold(spark):
    df = spark.range(36_000).selectExpr("id % 12000 AS g", "CAST(id AS DOUBLE) AS x")
    table = quantile_table(df, ["x"], [0.5], by=["g"])
    assert table.where("_q[0] = _k0 + 12000").count() == 12_000
