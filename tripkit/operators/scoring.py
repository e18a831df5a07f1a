"""Requests to predictions: validation, defaults, weather, post-processing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripkit.functions.weather import holds
from tripkit.operators.enrich import join_weather
from tripkit.operators.quality import reasons_of
from tripkit.schema import COORDINATES, DOCUMENTED, Thresholds

# Defaults of omitted request fields, and the smallest prediction.
DEFAULT_PASSENGERS, DEFAULT_VENDOR, DEFAULT_FLAG = 1, 1, "N"
VENDORS = (1, 2)
MIN_MINUTES = 0.1
MODEL_NAME = "eta-best-model"


def clean_flag(flag: Column) -> Column:
    """Trimmed and upper-cased; an omitted or empty flag is the default."""
    text = F.when(F.coalesce(flag, F.lit("")) == "", DEFAULT_FLAG).otherwise(flag)
    return F.upper(F.trim(text))


def request_time(text: Column) -> Column:
    return F.replace(text, F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")


def request_rules(limits: Thresholds = DOCUMENTED) -> dict[str, Column]:
    """Checks of one request (true means bad); omitted optional fields are fine."""
    rules = {
        c: ~holds(F.col(c).between(*(limits.lat if c.endswith("lat") else limits.lon))) for c in COORDINATES
    }
    passengers = F.coalesce("passenger_count", F.lit(DEFAULT_PASSENGERS))
    rules["pickup_datetime"] = request_time(F.col("pickup_datetime")).isNull()
    rules["passenger_count"] = ~passengers.between(1, limits.max_passengers)
    rules["vendor_id"] = ~F.coalesce("vendor_id", F.lit(DEFAULT_VENDOR)).between(*VENDORS)
    rules["precipitation"] = holds(F.col("precipitation") < 0)
    rules["snow_depth"] = holds(F.col("snow_depth") < 0)
    rules["store_and_fwd_flag"] = ~clean_flag(F.col("store_and_fwd_flag")).isin("Y", "N")
    given = F.col("dropoff_datetime")
    rules["dropoff_datetime"] = given.isNotNull() & request_time(given).isNull()
    return rules


def validate_requests(requests: DataFrame, limits: Thresholds = DOCUMENTED) -> DataFrame:
    """Add ``errors``: names of the fields that are not acceptable."""
    return requests.withColumn("errors", reasons_of(request_rules(limits)))


def with_defaults(requests: DataFrame) -> DataFrame:
    """Requests as raw trip rows: omitted fields filled, times parsed."""
    pickup = request_time(F.col("pickup_datetime"))
    weather = {c: F.coalesce(c, F.lit(0.0)) for c in ("avg_temp_f", "precipitation", "snow_depth")}
    return requests.withColumns({
        "pickup_datetime": pickup,
        "dropoff_datetime": F.coalesce(request_time(F.col("dropoff_datetime")), pickup),
        "passenger_count": F.coalesce("passenger_count", F.lit(DEFAULT_PASSENGERS)),
        "vendor_id": F.coalesce("vendor_id", F.lit(DEFAULT_VENDOR)),
        "store_and_fwd_flag": F.coalesce("store_and_fwd_flag", F.lit(DEFAULT_FLAG)),
        **weather,
    })


def look_up_weather(requests: DataFrame, weather: DataFrame, fill: dict[str, float] | None = None) -> DataFrame:
    """Fill omitted weather fields from the daily table; given values win.

    A date without weather gets ``fill``, the values that training used; without them, null.
    """
    fields = [c for c in ("avg_temp_f", "precipitation", "snow_depth") if c in weather.columns]
    given = requests.withColumnsRenamed({c: f"__given_{c}" for c in fields}).withColumn(
        "__at", request_time(F.col("pickup_datetime"))
    )
    joined = join_weather(given, weather, at="__at")
    filled = {c: F.coalesce(f"__given_{c}", c, F.lit((fill or {}).get(c)).cast("double")) for c in fields}
    return joined.withColumns(filled).select(*requests.columns)


def postprocess(
    scored: DataFrame, model_version: str, dataset_version: str, n_features: int,
    prediction: str = "prediction",
) -> DataFrame:
    """Floor the raw prediction, derive minutes and seconds, attach the identity."""
    minutes = F.greatest(F.col(prediction), F.lit(MIN_MINUTES))
    return scored.withColumns({
        "eta_minutes": F.round(minutes, 2),
        "eta_seconds": F.bround(minutes * 60).cast("int"),
        "model_name": F.lit(MODEL_NAME),
        "model_version": F.lit(model_version),
        "dataset_version": F.lit(dataset_version),
        "input_features": F.lit(n_features),
    })
