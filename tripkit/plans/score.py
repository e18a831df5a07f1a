"""Score request tables with a stored model and the preparation it was trained with."""

from __future__ import annotations

import importlib
from dataclasses import dataclass

from pyspark.ml.base import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressionModel, GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel,
)
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.operators.scoring import MODEL_NAME, look_up_weather, postprocess, validate_requests, with_defaults
from tripkit.plans.features import build_features
from tripkit.plans.prepare import FittedPrep, load_prep
from tripkit.session import materialize
from tripkit.sources.tracking import (
    append_stages, next_model_version, production_version, promotion_events, read_stages,
)

MODEL_CLASSES = {
    c.__name__: c
    for c in (
        LinearRegressionModel, DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressionModel,
    )
}
OUTPUT = [
    "eta_minutes", "eta_seconds", "model_name", "model_version", "dataset_version", "input_features",
]


@dataclass
class Scorer:
    prep: FittedPrep
    model: Model
    model_version: str
    dataset_version: str

    def predict(self, trips: DataFrame, fill: str = "median") -> DataFrame:
        """Trip rows, batch or stream, with a raw ``prediction`` column added."""
        keep = [c for c in trips.columns]
        features = build_features(trips.withColumns({f"__in_{c}": F.col(c) for c in keep}))
        ready = self.prep.apply(features, fill)
        vectors = VectorAssembler(
            inputCols=self.prep.feature_names, outputCol="features", handleInvalid="error"
        ).transform(ready)
        scored = self.model.transform(vectors)
        return scored.select(*[F.col(f"__in_{c}").alias(c) for c in keep], "prediction")

    def score(
        self, requests: DataFrame, weather: DataFrame | None = None, fill: str = "median"
    ) -> DataFrame:
        """One output row per request: a prediction, or an ``error`` for a bad request.

        ``request_ord`` carries the input order. A bad row never fails the batch, and the
        batch may be of any size.
        """
        if weather is not None:
            requests = look_up_weather(requests, weather, self.prep.weather_fill)
        checked = validate_requests(requests)
        if not checked.isStreaming:
            checked = materialize(checked)  # good and bad rows go two ways
        good = with_defaults(checked.where(F.size("errors") == 0).drop("errors"))
        scored = postprocess(
            self.predict(good, fill), self.model_version, self.dataset_version, len(self.prep.feature_names)
        )
        bad = checked.where(F.size("errors") > 0).select(
            "request_ord", F.concat(F.lit("invalid "), F.array_join("errors", ", ")).alias("error")
        )
        return scored.select("request_ord", *OUTPUT).unionByName(bad, allowMissingColumns=True)

    def identity(self, spark: SparkSession) -> DataFrame:
        """Which model and dataset this scorer answers with."""
        row = (MODEL_NAME, self.model_version, self.dataset_version, self.prep.feature_names)
        return spark.createDataFrame(
            [row], "model_name string, model_version string, dataset_version string, features array<string>"
        )


def register(model: Model, base: str, spark: SparkSession, dataset_version: str, promote: bool = True) -> int:
    """Save a model as the next registry version and, by default, put it in production."""
    events = read_stages(spark, base)
    version = next_model_version(events, MODEL_NAME)
    model.write().save(f"{base}/models/{version}")
    if promote:
        append_stages(promotion_events(events, MODEL_NAME, version, dataset_version), base)
    return version


def load_model(spark: SparkSession, path: str) -> Model:
    name = DefaultParamsReader.loadMetadata(path, spark)["class"].split(".")[-1]
    if name not in MODEL_CLASSES:  # a family outside Spark names its own class
        module, _, name = DefaultParamsReader.loadMetadata(path, spark)["class"].rpartition(".")
        return getattr(importlib.import_module(module), name).load(path)
    return MODEL_CLASSES[name].load(path)


def load_scorer(spark: SparkSession, base: str) -> Scorer:
    """The production model together with the dataset version it was trained on."""
    rows = production_version(read_stages(spark, base)).where(F.col("model") == MODEL_NAME).collect()
    if not rows:
        raise FileNotFoundError(f"no production model below {base}")
    version, dataset_version = rows[0]["version"], rows[0]["dataset_version"]
    model = load_model(spark, f"{base}/models/{version}")
    return Scorer(load_prep(spark, base, dataset_version), model, str(version), dataset_version)
