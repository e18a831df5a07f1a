"""Every registered query against its SQL on the driver's tables."""

from __future__ import annotations

import math

import pytest

import __spark_entry__ as registry


def normal(df):
    """Columns and rows in a fixed order, with comparable cell types."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
        elif str(df[c].dtype).startswith("Int") and df[c].isna().any():
            df[c] = df[c].astype("float64")  # as the other side's frames hold integers with nulls
        elif df[c].dtype == object:
            df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(name, spark, sf_dir, duck):
    got = normal(registry.queries()[name](spark, sf_dir).toPandas())
    want = normal(duck.execute(registry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want) > 0
    for c in got.columns:
        differ = (got[c] != want[c]) & ~(got[c].isna() & want[c].isna())
        assert not differ.any(), (c, got[c][differ].head().tolist(), want[c][differ].head().tolist())
        assert got[c].dtype == want[c].dtype, c


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_has_rows(name, spark, sf_dir):
    assert registry.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert 0 < len(rows) <= 24 and {"hour_of_day", "mean_target", "n_rows"} == set(rows[0].asDict())
