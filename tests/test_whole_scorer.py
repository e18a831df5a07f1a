"""One scorer on all features: what training saw, batch requests and a stream get the same answers."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogue import scoring
from catalogue.quality import stored_clean
from tripkit.operators import enrich
from tripkit.plans.features import build_features
from tripkit.session import materialize
from tripkit.sources import derived


@pytest.fixture(scope="module")
def scorer(spark, sf_dir):
    return scoring.whole_scorer(spark, sf_dir)


def by_order(df, value="prediction"):
    return {r[0]: r[1] for r in df.select(df.columns[0], value).collect()}


@pytest.fixture(scope="module")
def trained(spark, sf_dir, scorer):
    """Predictions from the features that training builds, computed from the coefficients."""
    weather = materialize(derived.weather(spark, sf_dir))
    table = enrich.enrich(stored_clean(spark, sf_dir), weather)
    rows = scorer.prep.apply(build_features(table)).select("row_ord", *scorer.prep.feature_names).collect()
    x = np.array([list(r)[1:] for r in rows], float)
    return dict(zip([r["row_ord"] for r in rows], x @ scorer.model.coefficients.toArray() + scorer.model.intercept, strict=True))


def undated(spark, sf_dir):
    """Clean trips on dates without weather."""
    weather = derived.weather(spark, sf_dir)
    trips = stored_clean(spark, sf_dir).withColumn("date", F.to_date("pickup_datetime"))
    return {r["row_ord"] for r in trips.join(weather, "date", "left_anti").collect()}


def test_all_features_are_used(scorer):
    assert len(scorer.prep.feature_names) == 34
    assert {"avg_temp_f", "precipitation", "snow_depth"} <= set(scorer.prep.weather_fill) | {"snow_depth"}
    assert np.count_nonzero(scorer.model.coefficients.toArray()) > 25


def test_stream_gives_what_training_saw(spark, sf_dir, scorer, trained):
    got = by_order(scoring.scored_stream(scorer, spark, sf_dir))
    assert set(trained) <= set(got) and len(trained) > 500
    assert {k: got[k] for k in trained} == pytest.approx({k: round(v, 4) for k, v in trained.items()}, abs=2e-4)
    assert undated(spark, sf_dir) & set(trained)


def test_batch_gives_what_training_saw(spark, sf_dir, scorer, trained):
    """Requests made of clean trips without any weather of their own: looked up, or the stored fill."""
    text = {c: F.replace(F.col(c).cast("string"), F.lit(" "), F.lit("T")) for c in ("pickup_datetime", "dropoff_datetime")}
    requests = stored_clean(spark, sf_dir).withColumns(text).withColumnRenamed("row_ord", "request_ord").withColumns(
        {c: F.lit(None).cast("double") for c in ("avg_temp_f", "precipitation", "snow_depth")})
    answered = scorer.score(requests, derived.weather(spark, sf_dir)).where("error IS NULL")
    got = by_order(answered.select("request_ord", "eta_minutes"), "eta_minutes")
    assert len(got) > 0.5 * len(trained) and set(got) <= set(trained)
    assert got == pytest.approx({k: round(max(trained[k], 0.1), 2) for k in got}, abs=0.011)
    assert undated(spark, sf_dir) & set(got)


def test_weather_reaches_the_prediction(spark, sf_dir, scorer):
    trips = stored_clean(spark, sf_dir).limit(20).withColumns({"precipitation": F.lit(0.0), "snow_depth": F.lit(0.0)})
    cold, warm = (by_order(scorer.predict(trips.withColumn("avg_temp_f", F.lit(t))).select("row_ord", "prediction")) for t in (10.0, 90.0))
    assert cold.keys() == warm.keys() and any(abs(cold[k] - warm[k]) > 1e-6 for k in cold)


def test_registered_answers_cover_every_request(spark, sf_dir):
    answered = scoring.batch_score_whole(spark, sf_dir)
    row = answered.agg(F.count(F.lit(1)).alias("n"), F.expr("count_if(input_features = 34 AND error IS NULL)").alias("good"),
                       F.expr("count_if(eta_minutes = -1 AND error IS NOT NULL)").alias("bad")).first()
    assert row["n"] == row["good"] + row["bad"] == derived.trips(spark, sf_dir).count() and row["good"] and row["bad"]
