"""Statistics against pandas and numpy, including nulls, ties and constants."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from tripkit.operators import monitoring, stats
from tripkit.operators.content import hash_text
from tripkit.operators.sampling import seeded_sample
from tripkit.plans.profile import profile


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(11)
    n = 3000
    frame = pd.DataFrame({
        "a": rng.gamma(2.0, 3.0, n), "b": rng.normal(1e6, 2.0, n), "c": rng.integers(0, 5, n).astype(float),
        "flat": np.full(n, 0.1), "key": rng.integers(0, 3, n),
    })
    frame["d"] = frame["a"] * 0.3 + rng.normal(size=n)
    frame.loc[::7, "a"] = np.nan
    frame.loc[::5, "d"] = np.nan
    return frame


@pytest.fixture(scope="module")
def df(spark, pdf):
    table = spark.createDataFrame(pdf).repartition(8)
    return table.select(*[F.nanvl(c, F.lit(None)).alias(c) if c != "key" else F.col(c) for c in pdf.columns])


def test_describe(df, pdf):
    columns = ["a", "b", "c", "d", "flat"]
    got = stats.describe(df, columns).toPandas().set_index("column")
    want = pdf[columns].describe().T.round(4)
    want.columns = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    np.testing.assert_allclose(got.loc[columns, want.columns], want, atol=1.01e-4)


def test_approximate_describe_is_close(df, pdf):
    got = stats.describe_approximate(df, ["a"]).first()
    assert got["p50"] == pytest.approx(pdf["a"].median(), rel=0.02) and got["count"] == pdf["a"].count()


def test_shape_statistics(df, pdf):
    row = stats.shape_statistics(df, ["a"]).first()
    assert row["skewness"] == pytest.approx(pdf["a"].skew(), rel=1e-9)
    assert row["kurtosis"] == pytest.approx(pdf["a"].kurtosis(), rel=1e-9)


def test_shape_of_too_few_rows(spark):
    row = stats.shape_statistics(spark.createDataFrame([(1.0,), (2.0,)], "x double"), ["x"]).first()
    assert row["skewness"] is None and row["kurtosis"] is None


def test_correlation(df, pdf):
    columns = ["a", "b", "c", "d", "flat"]
    want = pdf[columns].corr()
    rows = stats.correlation_pairs(df, columns).collect()
    assert len(rows) == 10
    for r in rows:
        assert columns.index(r["col_a"]) > columns.index(r["col_b"])
        if "flat" in (r["col_a"], r["col_b"]):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(want.loc[r["col_a"], r["col_b"]], abs=1e-9)


def test_correlation_where_a_column_is_constant_over_the_shared_rows(spark):
    rows = [(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (None, 7.0)]
    assert stats.correlation_pairs(spark.createDataFrame(rows, "x double, y double"), ["x", "y"]).first()["corr"] is None


def test_histogram_matches_numpy(df, pdf):
    got = {c: np.zeros(40, int) for c in ("a", "c")}
    for r in stats.histogram(df, ["a", "c"], 40).collect():
        got[r["column"]][r["bin"]] = r["n_rows"]
    for c in got:
        assert got[c].tolist() == np.histogram(pdf[c].dropna(), bins=40)[0].tolist()


def test_histogram_of_a_constant(df):
    rows = stats.histogram(df, ["flat"], 10).collect()
    assert [(r["bin"], r["n_rows"]) for r in rows] == [(5, 3000)]


def test_value_counts_skip_nulls(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "v string")
    assert [tuple(r) for r in stats.value_counts(df, ["v"]).collect()] == [("v", "x", 2), ("v", "y", 1)]


def test_box_statistics(df, pdf):
    for r in stats.box_statistics(df, "key", "a").collect():
        x = pdf.loc[pdf["key"] == r["key"], "a"].dropna()
        q1, median, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, median, q3))
        assert (r["whisker_low"], r["whisker_high"]) == (inside.min(), inside.max())
        assert r["n_outliers"] == len(x) - len(inside) and r["n_rows"] == len(x)


def test_hex_cells_take_the_nearest_centre(spark):
    rng = np.random.default_rng(1)
    xy = rng.random((500, 2))
    df = spark.createDataFrame([tuple(map(float, r)) for r in xy], "x double, y double")
    rows = stats.hex_density(df, "x", "y", 10).collect()
    assert sum(r["n_rows"] for r in rows) == 500
    # brute force: every point goes to the nearest centre of both lattices
    (x0, x1), (y0, y1) = (xy[:, 0].min(), xy[:, 0].max()), (xy[:, 1].min(), xy[:, 1].max())
    sx, sy = (xy[:, 0] - x0) / ((x1 - x0) / 10), (xy[:, 1] - y0) / ((y1 - y0) / 5)
    centres = [(l, i, j, i + l / 2, j + l / 2) for l in (0, 1) for i in range(-1, 12) for j in range(-1, 7)]
    counts: dict = {}
    for px, py in zip(sx, sy):
        best = min(centres, key=lambda c: (px - c[3]) ** 2 + 3 * (py - c[4]) ** 2)
        counts[best[:3]] = counts.get(best[:3], 0) + 1
    assert {(r["lattice"], r["cell_x"], r["cell_y"]): r["n_rows"] for r in rows} == counts


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(1000)
    one = {r["id"] for r in seeded_sample(df.repartition(1), F.col("id"), 50).collect()}
    many = {r["id"] for r in seeded_sample(df.repartition(13), F.col("id"), 50).collect()}
    assert one == many and len(one) == 50
    assert seeded_sample(df.limit(3), F.col("id"), 50).count() == 3
    other = {r["id"] for r in seeded_sample(df, F.col("id"), 50, seed=7).collect()}
    assert other != one


def test_content_hash(df):
    base = hash_text(df)
    assert hash_text(df.repartition(3)) == base and len(base) == 16
    assert hash_text(df.withColumn("c", F.when(F.col("a") == F.lit(-1), 9.0).otherwise(F.col("c")))) == base
    first = df.agg(F.min("b")).first()[0]
    assert hash_text(df.withColumn("c", F.when(F.col("b") == first, 99.0).otherwise(F.col("c")))) != base
    assert hash_text(df.unionAll(df.limit(1))) != base


def test_content_hash_tells_null_from_empty(spark):
    assert hash_text(spark.createDataFrame([("", None)], "a string, b string")) != hash_text(
        spark.createDataFrame([(None, "")], "a string, b string"))


def test_drift_of_equal_and_shifted_data(df):
    same = monitoring.drift(df, df, ["a", "b"]).collect()
    assert [r["psi"] for r in same] == [0.0, 0.0]
    shifted = monitoring.drift(df, df.withColumn("b", F.col("b") + 5), ["b"]).first()["psi"]
    assert shifted > 0.25


def test_profile_goes_on_after_a_failing_part(spark, sf_dir):
    from tripkit.sources import derived

    trips = derived.trips(spark, sf_dir).drop("pickup_lon")
    tables, failures = profile(trips)
    assert "pickup_density" in failures and "mean_by_hour" in tables
    assert tables["mean_by_weekday"].count() == 7


def test_counted_tables_equal_those_of_their_own_scans(spark, sf_dir):
    from tripkit.functions import time, weather
    from tripkit.operators import stats
    from tripkit.plans import profile as plan
    from tripkit.sources import derived

    trips = derived.trips(spark, sf_dir).withColumns({
        "avg_temp_f": F.when(F.col("row_ord") % 7 != 0, (F.col("row_ord") % 90).cast("double")), "precipitation": F.lit(0.3), "snow_depth": F.lit(0.0),
        "eta_minutes": F.when(F.col("row_ord") % 5 != 0, F.col("eta_minutes")).when(F.col("row_ord") % 10 == 0, float("nan"))})
    tables, failures = profile(trips)
    assert not failures
    wide, ts = plan.calendar(trips), F.col("pickup_datetime")
    plotted = [c for c in plan.PROFILE_NUMERICS if c in wide.columns and c != "is_weekend"]
    own = {
        "shape": stats.table_shape(trips), "missing": stats.missing_counts(trips), "target_shape": stats.shape_statistics(trips, ["eta_minutes"]),
        "target_histogram": stats.histogram(trips, ["eta_minutes"], plan.TARGET_BINS), "target_log_histogram": stats.log_histogram(trips, "eta_minutes", plan.TARGET_BINS),
        "numeric_histograms": stats.histogram(wide, plotted, plan.NUMERIC_BINS), "value_counts": stats.value_counts(trips, ["vendor_id", "store_and_fwd_flag"]),
        "distance_target": stats.grid_counts(plan.with_distance(trips).withColumn("is_rush_hour", time.is_rush_hour(ts)), "is_rush_hour", "haversine_km", "eta_minutes", 1.0, 5.0),
        "mean_by_hour": stats.mean_by(trips, F.hour(ts), "hour", "eta_minutes"), "mean_by_weekday": plan.mean_by_weekday(trips),
        "mean_by_temperature": plan.mean_by_temperature(trips), "mean_by_rain": stats.mean_by(trips, weather.rain_label(F.col("precipitation")), "rain", "eta_minutes"),
        "pickup_density": stats.hex_density(trips, "pickup_lon", "pickup_lat", plan.HEX_COLUMNS),
    }

    def rows(df):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in map(tuple, df.collect()))

    for name, table in own.items():
        assert tables[name].columns == table.columns and str(rows(tables[name])) == str(rows(table)), name


def test_a_failing_value_stops_one_counted_table_only(spark):
    """What fails in the one scan is found by scans of the tables one by one."""
    from tripkit.plans import profile as plan

    trips = spark.createDataFrame([("x", 5.0), ("1", 7.0)], "code string, eta_minutes double")
    good, bad = plan.cell("good", x=F.col("eta_minutes")), plan.cell("bad", part=F.expr("CAST(CAST(code AS INT) AS STRING)"))
    sources, failures = plan.counted_sources(trips, {"good": [good], "bad": [bad], "other": []}, {"other": "good"})
    assert list(failures) == ["bad"] and sources.keys() == {"good", "other"}
    assert [(r.family, r.n, r.s1) for r in sources["other"].collect()] == [("good", 2, 12.0)]


def test_no_wide_row_is_tagged_cell_by_cell(spark, sf_dir, monkeypatch):
    """Rows that one scan hands to the counters stay few; their sums do not depend on how cells are dealt to scans."""
    from tripkit.plans import profile as plan
    from tripkit.sources import derived

    trips, given = derived.trips(spark, sf_dir), []
    counters = plan.counters
    monkeypatch.setattr(plan, "counters", lambda df, cells: given.append(len(cells)) or counters(df, cells))
    tables, failures = profile(trips)
    assert not failures and sum(given) <= 12 < len(trips.columns)
    cells = [plan.cell(f"f{k}", part=F.col("vendor_id") % (k + 1), x=F.col("passenger_count") * k) for k in range(7)]
    found = {}
    for size in (1, 3, 7):
        monkeypatch.setattr(plan, "CELLS", size)
        found[size] = sorted((r.family, r.part, r.n, r.known, r.s1) for r in counters(trips, cells).collect())
    assert found[1] == found[3] == found[7] and sum(r[2] for r in found[1]) == 7 * trips.count()


def test_aggregates_per_column_equal_those_side_by_side(spark):
    from tripkit.operators import prep
    from tripkit.operators.selection import per_column

    columns = [f"c{k}" for k in range(40)]
    wide = spark.range(200).select(*[F.when((F.col("id") + k) % 9 != 0, (F.col("id") * (k + 3) % 17).cast("float")).alias(c) for k, c in enumerate(columns)])
    found = per_column(wide, {c: F.col(c) for c in columns}, [F.avg("_val").alias("mean"), F.count("_val").alias("n")])
    direct = wide.agg(*[f(F.col(c).cast("double")).alias(f"{c}{n}") for c in columns for n, f in (("m", F.avg), ("n", F.count))]).first()
    assert all(found[c]["n"] == direct[f"{c}n"] and abs(found[c]["mean"] - direct[f"{c}m"]) < 1e-12 for c in columns)
    assert per_column(wide.limit(0), {"c0": F.col("c0")}, [F.avg("_val")]) == {}
    for kind in ("standard", "minmax"):
        assert prep.fit_scaler(wide.limit(0), columns[:2], kind) == dict.fromkeys(columns[:2], (0.0, 1.0))
    assert prep.fit_scaler(wide, ["c0"], "minmax")["c0"] == (0.0, 16.0)
