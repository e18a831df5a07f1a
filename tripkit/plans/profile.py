"""The whole set of exploratory statistics as named tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.functions import time, weather
from tripkit.functions.geo import great_circle_km, hex_cell
from tripkit.operators import stats
from tripkit.operators.enrich import dense
from tripkit.schema import COORDINATES, PROFILE_CATEGORICALS, PROFILE_NUMERICS, TARGET
from tripkit.session import materialize

# Bin counts of the distribution tables and the hexagon grid.
TARGET_BINS, NUMERIC_BINS, HEX_COLUMNS = 60, 40, 50
#: Cells that one projection makes of a row.
CELLS = 2


def calendar(df: DataFrame) -> DataFrame:
    ts = F.col("pickup_datetime")
    return df.withColumns({
        "hour_of_day": time.hour_of_day(ts), "day_of_week": time.day_of_week(ts),
        "month": F.month(ts), "is_weekend": time.is_weekend(ts),
    })


def with_distance(df: DataFrame) -> DataFrame:
    if "haversine_km" in df.columns:
        return df
    return df.withColumn("haversine_km", great_circle_km(*[F.col(c) for c in COORDINATES]))


def mean_by_weekday(df: DataFrame, target: str = TARGET) -> DataFrame:
    means = stats.mean_by(df, time.weekday_name(F.col("pickup_datetime")), "weekday", target)
    return dense(means, "weekday", time.WEEKDAYS)


def mean_by_temperature(df: DataFrame, target: str = TARGET) -> DataFrame:
    banded = df.withColumn("temp_band", weather.temperature_band(F.col("avg_temp_f")))
    means = stats.mean_by(banded.where(F.col("temp_band").isNotNull()), F.col("temp_band"), "temp_band", target)
    return dense(means, "temp_band", [name for name, _, _ in weather.TEMPERATURE_BANDS])


# ------------------------------------------------------------- tables from one scan
#
# Most tables count rows, or add up the target, per group. Their rows are tagged with the table they count for
# and go through one aggregation: tables read its few counters, not the trips. Tables of one row, or of many columns
# with plain numbers for groups, are not among them: tagging every cell of a wide row costs far more than a scan.


def cell(family: str, column: str | None = None, part: Column | None = None, bin: Column | None = None,
         bin2: Column | None = None, x: Column | None = None, where: Column | None = None) -> Column:
    """One tagged row of a family of counters; null where it does not count."""
    values = {"family": (F.lit(family), "string"), "column": (F.lit(column), "string"), "part": (part, "string"), "bin": (bin, "bigint"),
              "bin2": (bin2, "bigint"), "x": (x, "double")}
    row = F.struct(*((F.lit(None) if v is None else v).cast(kind).alias(name) for name, (v, kind) in values.items()))
    return row if where is None else F.when(where, row)


def counters(df: DataFrame, cells: list[Column]) -> DataFrame:
    """n rows, known values of x and their sum, per family, column, part and bins; written once, by one job.

    ``CELLS`` cells at a time are counted beside each other: the code generated for many more in one projection is
    too long for the JVM to compile, and is interpreted.
    """
    x = F.col("x")
    parts = []
    for k in range(0, len(cells), CELLS):
        tagged = df.select(F.inline(F.array(*cells[k : k + CELLS]))).where("family IS NOT NULL")
        parts.append(tagged.groupBy("family", "column", "part", "bin", "bin2").agg(
            F.count(F.lit(1)).alias("n"), F.count(x).alias("known"), F.sum(x).alias("s1")))
    return materialize(reduce(DataFrame.unionByName, parts))


@dataclass(frozen=True)
class Counted:
    """A table made of counters: their cells, and how the table reads them."""

    cells: Callable[[], list[Column]]
    table: Callable[[DataFrame], DataFrame]


def binned_cells(df: DataFrame, family: str, columns: list[str], bins: int, ranges: dict, value: Callable[[Column], Column] = F.col) -> list[Column]:
    out = []
    for c in columns:
        if ranges.get(c):
            number = stats.bin_number(value(c).cast("double"), F.lit(ranges[c][0]), F.lit(ranges[c][1]), bins)
            out.append(cell(family, c, bin=number, where=number.isNotNull()))
    return out


def means(key: str, kind: str) -> Callable[[DataFrame], DataFrame]:
    return lambda t: t.select(F.col("part").cast(kind).alias(key), F.try_divide("s1", "known").alias("mean_target"), F.col("known").alias("n_rows"))


def counted_tables(df: DataFrame, wide: DataFrame, ranges: dict, target: str) -> dict[str, Counted]:
    """The tables that come from counters, by name. ``wide`` has the columns that cells refer to."""
    ts, y = F.col("pickup_datetime"), F.nanvl(F.col(target).cast("double"), F.lit(None).cast("double"))
    categorical = [c for c in PROFILE_CATEGORICALS if c in df.columns]
    log = f"log1p_{target}"
    known = [~stats.missing(wide, c) for c in ("haversine_km", target)]

    def edged(bins: int) -> Callable[[DataFrame], DataFrame]:
        return lambda t: stats.with_edges(t.select("column", F.col("bin").cast("int").alias("bin"), F.col("n").alias("n_rows")), ranges, bins)

    def density() -> list[Column]:
        spans = [stats.padded(*ranges[c]) for c in ("pickup_lon", "pickup_lat")]
        lattice, x, row = hex_cell(F.col("pickup_lon"), F.col("pickup_lat"), *spans, HEX_COLUMNS)
        return [cell("pickup_density", part=lattice, bin=x, bin2=row, where=F.col("pickup_lon").isNotNull() & F.col("pickup_lat").isNotNull())]

    def centres(t: DataFrame) -> DataFrame:
        spans = [stats.padded(*ranges[c]) for c in ("pickup_lon", "pickup_lat")]
        cells = t.select(F.col("part").cast("int").alias("lattice"), F.col("bin").alias("cell_x"), F.col("bin2").alias("cell_y"), F.col("n").alias("n_rows"))
        return stats.with_centres(cells, *spans, HEX_COLUMNS)

    def mean(name: str, key: Column, to: Callable[[DataFrame], DataFrame], where: Column | None = None) -> Counted:
        return Counted(lambda: [cell(name, part=key, x=y, where=where)], to)

    band = weather.temperature_band(F.col("avg_temp_f"))
    tables = {
        "target_histogram": Counted(lambda: binned_cells(wide, "target_histogram", [target], TARGET_BINS, ranges), edged(TARGET_BINS)),
        "target_log_histogram": Counted(
            lambda: binned_cells(wide, "target_log_histogram", [log], TARGET_BINS, ranges, lambda c: F.log1p(target)), edged(TARGET_BINS)),
        "value_counts": Counted(
            lambda: [cell("value_counts", c, part=F.col(c), where=F.col(c).isNotNull()) for c in categorical],
            lambda t: t.select("column", F.col("part").alias("value"), F.col("n").alias("n_rows")).orderBy("column", F.desc("n_rows"), "value")),
        "distance_target": Counted(
            lambda: [cell("distance_target", part=time.is_rush_hour(ts), bin=F.floor(F.col("haversine_km") / 1.0), bin2=F.floor(F.col(target) / 5.0),
                          where=known[0] & known[1])],
            lambda t: t.select(F.col("part").cast("int").alias("is_rush_hour"), F.col("bin").alias("x_bin"), F.col("bin2").alias("y_bin"), F.col("n").alias("n_rows"))),
        "mean_by_hour": mean("mean_by_hour", F.hour(ts), means("hour", "int")),
        "mean_by_weekday": mean("mean_by_weekday", time.weekday_name(ts), lambda t: dense(means("weekday", "string")(t), "weekday", time.WEEKDAYS)),
        "mean_by_month": mean("mean_by_month", F.month(ts), means("month", "int")),
        "pickup_density": Counted(density, centres),
    }
    if "avg_temp_f" in df.columns:
        bands = [name for name, _, _ in weather.TEMPERATURE_BANDS]
        tables["mean_by_temperature"] = mean("mean_by_temperature", band, lambda t: dense(means("temp_band", "string")(t), "temp_band", bands), band.isNotNull())
    if "precipitation" in df.columns:
        tables["mean_by_rain"] = mean("mean_by_rain", weather.rain_label(F.col("precipitation")), means("rain", "string"))
    if "snow_depth" in df.columns:
        tables["mean_by_snow"] = mean("mean_by_snow", weather.is_snowing(F.col("snow_depth")), means("is_snowing", "int"))
    return tables


def counted_sources(df: DataFrame, cells: dict[str, list[Column]], shared: dict[str, str] | None = None) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Counters of each table, all from one scan, or from scans of their own if a cell fails on some value.

    ``shared`` names tables that read the counters of another one.
    """
    try:
        counted = counters(df, [c for own in cells.values() for c in own])
        return dict.fromkeys(cells, counted), {}
    except Exception:  # find out which
        sources, failures = {}, {}
    for name, own in cells.items():
        try:
            if own:
                sources[name] = counters(df, own)
        except Exception as error:
            failures[name] = str(error)
    sources |= {name: sources[of] for name, of in (shared or {}).items() if name in cells and of in sources}
    return sources, failures


def profile(df: DataFrame, target: str = TARGET) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """All statistics of a clean trip table, by name, and the reason for each that could not be built.

    One scan takes the ranges of all columns, one job all counters, a few cells a scan; nulls, the target's moments and the
    histograms of all columns have one each. Quartiles (describe, boxes) are narrowed by passes of their own, and
    pair sums of the correlations by one. A table whose cells cannot be
    analysed is left out of the scan; should the scan fail, each table's counters are taken alone.
    """
    failures: dict[str, str] = {}
    wide = calendar(df)
    try:
        wide = with_distance(wide)
    except Exception as error:  # without coordinates there is no distance
        failures["distance_target"] = str(error)
        wide = wide.withColumn("haversine_km", F.lit(None).cast("double"))
    log = f"log1p_{target}"
    numeric = [c for c in PROFILE_NUMERICS if c in calendar(df).columns]
    spanned = list(dict.fromkeys([c for c in [*numeric, target, "pickup_lon", "pickup_lat"] if c in wide.columns]))
    ranges = stats.value_ranges(wide.withColumn(log, F.log1p(target)), [*spanned, log])
    plotted = [c for c in PROFILE_NUMERICS if c in wide.columns and c != "is_weekend"]
    tables: dict[str, DataFrame] = {}
    found = counted_tables(df, wide, ranges, target)
    cells: dict[str, list[Column]] = {}
    for name, own in found.items():
        if name in failures:
            continue
        try:
            cells[name] = own.cells()
            wide.select(*(c.alias(f"c{k}") for k, c in enumerate(cells[name])))
        except Exception as error:  # one failing part must not stop the others
            failures[name] = str(error)
            cells.pop(name, None)
    sources, failed = counted_sources(wide, cells)
    failures |= failed
    builders = {name: (lambda t=found[name].table, s=source, f=name: t(s.where(F.col("family") == f)))
                for name, source in sources.items()}
    builders |= {
        "shape": lambda: stats.table_shape(df), "types": lambda: stats.column_types(df), "missing": lambda: stats.missing_counts(df),
        "target_shape": lambda: stats.shape_statistics(df, [target]),
        "numeric_histograms": lambda: stats.histogram(wide, plotted, NUMERIC_BINS, ranges), "describe": lambda: stats.describe(df),
        "correlation": lambda: stats.correlation_pairs(calendar(df), [*numeric, target]),
        "box_by_hour": lambda: stats.box_statistics(calendar(df), "hour_of_day", target),
    }
    for name, build in builders.items():
        try:
            tables[name] = build()
        except Exception as error:
            failures[name] = str(error)
    return tables, failures


def write_profile(tables: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Write every table, and return the reason for each that could not be computed."""
    failures = {}
    for name, table in tables.items():
        try:
            table.write.mode("errorifexists").json(f"{base}/{name}")
        except Exception as error:  # tables are lazy: most failures show only here
            failures[name] = str(error)
    return failures
