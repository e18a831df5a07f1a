"""Clean trips to a versioned, model-ready dataset."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.operators import prep, splitting
from tripkit.operators.content import hash_text
from tripkit.plans.features import assert_columns, build_features
from tripkit.schema import NON_FEATURES, ROW_ORDER, SEED, TARGET, TEST_SIZE, VAL_SIZE
from tripkit.session import materialize
from tripkit.sources.versions import load_version, write_version


@dataclass
class FittedPrep:
    """Everything learned from the train rows; enough to repeat the preparation later."""

    numeric: list[str]
    categorical: list[str]
    encoder: str
    scaler_kind: str
    medians: dict[str, float]
    scaler: dict[str, tuple[float, float]]
    categories: DataFrame | None = None
    indicators: list[str] = field(default_factory=list)
    weather_fill: dict[str, float] = field(default_factory=dict)

    @property
    def feature_names(self) -> list[str]:
        if self.encoder == "onehot":
            return self.numeric + self.indicators
        return self.numeric + self.categorical

    def encode(self, df: DataFrame) -> DataFrame:
        if not self.categorical:
            return df
        if self.encoder == "ordinal":
            return prep.ordinal_encode(df, self.categories, self.categorical)
        return prep.onehot_encode(df, self.categories, self.categorical)

    def apply(self, df: DataFrame, fill: str = "median") -> DataFrame:
        """Encode, fill nulls and scale. ``fill="zero"`` uses 0 instead of the train medians."""
        assert_columns(df, self.numeric + self.categorical)
        values = self.medians if fill == "median" else dict.fromkeys(self.numeric, 0.0)
        return prep.scale(prep.impute(self.encode(df), values), self.scaler)

    def metadata(self) -> dict:
        return {
            "numeric_features": self.numeric,
            "categorical_features": self.categorical,
            "scaler_type": self.scaler_kind,
            "encoder_type": self.encoder,
            "medians": self.medians,
            "scaler": {c: list(v) for c, v in self.scaler.items()},
            "weather_fill": self.weather_fill,
        }


def fit_prep(
    train: DataFrame,
    encoder: str = "ordinal",
    scaler: str = "standard",
    excluded: list[str] | None = None,
) -> FittedPrep:
    """Learn categories, medians and scaling from the train rows only."""
    prep.choose(encoder, prep.ENCODERS, "encoder")
    prep.choose(scaler, prep.SCALERS, "scaler")
    hidden = [*NON_FEATURES, ROW_ORDER, "stratum", "split", *(excluded or [])]
    numeric, categorical = prep.feature_columns(train, hidden)
    categories, indicators = None, []
    if categorical:
        categories = prep.fit_categories(train, categorical)
        if encoder == "onehot":
            names = prep.onehot_names(categories, categorical)
            indicators = [f"{c}_{v}" for c in categorical for v in names[c]]
    medians = prep.fit_medians(train, numeric)
    fitted = prep.fit_scaler(prep.impute(train, medians), numeric, scaler)
    return FittedPrep(numeric, categorical, encoder, scaler, medians, fitted, categories, indicators)


def split_trips(
    df: DataFrame,
    mode: str = "hash",
    key: str = "trip_id",
    test_size: float = TEST_SIZE,
    val_size: float = VAL_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Add ``split``. ``hash`` needs no statistics; ``exact`` gives exact stratified sizes."""
    prep.choose(mode, ("hash", "exact", "time"), "split mode")
    if mode == "hash":
        return splitting.hash_split(df, key, test_size, val_size, seed)
    if mode == "time":
        return splitting.time_split(df, test_size=test_size)
    stratified = splitting.add_strata(df.where(F.col(TARGET).isNotNull()))
    return splitting.exact_split(
        stratified, key, test_size=test_size, val_size=val_size, seed=seed
    ).drop("stratum")


def prepare(
    clean: DataFrame, encoder: str = "ordinal", scaler: str = "standard", mode: str = "hash", **sizes
) -> tuple[DataFrame, FittedPrep]:
    """Features, split, fit on train, apply to all: one table with ``split`` and the target.

    The row features do not look at other rows, so they are computed once before the
    split; only the fitted statistics are restricted to train.
    """
    assert_columns(clean, [TARGET])
    features = materialize(build_features(split_trips(clean, mode, **sizes)))  # read by every fitting pass
    fitted = fit_prep(features.where(F.col("split") == "train"), encoder, scaler)
    table = fitted.apply(features).select(
        *fitted.feature_names, F.col(TARGET).cast("double").alias(TARGET), "split"
    )
    return table, fitted


def prepare_and_version(
    clean: DataFrame, base: str, encoder: str = "ordinal", scaler: str = "standard",
    mode: str = "hash", weather_fill: dict[str, float] | None = None, **sizes,
) -> tuple[str, FittedPrep]:
    """``prepare`` and write the result as the next immutable version below ``base``.

    ``weather_fill`` is what trips without weather got; scoring gives such requests the same.
    """
    table, fitted = prepare(clean, encoder, scaler, mode, **sizes)
    fitted.weather_fill = weather_fill or {}
    version = write_version(table, base, {**fitted.metadata(), "content_hash": hash_text(clean)})
    if fitted.categories is not None:
        fitted.categories.write.mode("errorifexists").parquet(f"{base}/{version}/categories")
    return version, fitted


def load_prep(spark: SparkSession, base: str, version: str) -> FittedPrep:
    """The fitted preparation of a stored version."""
    meta = load_version(spark, base, version)["metadata"]
    categorical, encoder = meta["categorical_features"], meta["encoder_type"]
    categories, indicators = None, []
    if categorical:
        categories = spark.read.parquet(f"{base}/{version}/categories")
        if encoder == "onehot":
            names = prep.onehot_names(categories, categorical)
            indicators = [f"{c}_{v}" for c in categorical for v in names[c]]
    return FittedPrep(
        meta["numeric_features"], categorical, encoder, meta["scaler_type"], meta["medians"],
        {c: (v[0], v[1]) for c, v in meta["scaler"].items()}, categories, indicators, meta["weather_fill"] or {},
    )
