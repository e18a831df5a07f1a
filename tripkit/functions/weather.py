"""Weather and flag features, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rain threshold in inches and the right-closed temperature bands.
RAIN_INCHES = 0.1
TEMPERATURE_BANDS = [
    ("Freezing (<32F)", 0.0, 32.0),
    ("Cold (32-50F)", 32.0, 50.0),
    ("Cool (50-65F)", 50.0, 65.0),
    ("Warm (65-80F)", 65.0, 80.0),
    ("Hot (>80F)", 80.0, 120.0),
]


def holds(condition: Column) -> Column:
    """A condition where an unknown outcome counts as false."""
    return F.coalesce(condition, F.lit(False))


def is_snowing(snow_depth: Column) -> Column:
    return holds(snow_depth > 0).cast("int")


def is_raining(precipitation: Column, snow_depth: Column) -> Column:
    """Enough rain, and no snow on the ground."""
    return (holds(precipitation > RAIN_INCHES) & ~holds(snow_depth > 0)).cast("int")


def rain_label(precipitation: Column) -> Column:
    return F.when(holds(precipitation > RAIN_INCHES), "Rainy").otherwise("Dry")


def temperature_band(temperature: Column) -> Column:
    """Name of the band holding a temperature; null outside all bands."""
    band = F.lit(None).cast("string")
    for name, low, high in reversed(TEMPERATURE_BANDS):
        band = F.when((temperature > low) & (temperature <= high), name).otherwise(band)
    return band


def store_flag(flag: Column) -> Column:
    """1 for a trimmed, case-folded 'Y'; 0 for anything else including null."""
    return holds(F.upper(F.trim(flag)) == "Y").cast("int")
