"""Calendar features of a pickup time. All are plain column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripkit.functions.numbers import rounded

# Monday-first names, used for dense weekday output.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def is_rush_hour(ts: Column) -> Column:
    """Weekday with the clock hour in 7..9 or 16..19, both ends included."""
    hour = F.hour(ts)
    return ((F.weekday(ts) < 5) & (hour.between(7, 9) | hour.between(16, 19))).cast("int")


def part_of_day(ts: Column) -> Column:
    hour = F.hour(ts)
    return (
        F.when(hour.between(5, 11), "morning")
        .when(hour.between(12, 16), "afternoon")
        .when(hour.between(17, 20), "evening")
        .when(hour.isNotNull(), "night")
    )


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a circle of ``period`` steps, 6 decimals."""
    angle = value * F.lit(2 * math.pi) / F.lit(float(period))
    return rounded(F.sin(angle), 6), rounded(F.cos(angle), 6)


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def time_features(ts: Column) -> dict[str, Column]:
    hour_sin, hour_cos = cycle(F.hour(ts), 24)
    dow_sin, dow_cos = cycle(F.weekday(ts), 7)
    month_sin, month_cos = cycle(F.month(ts) - 1, 12)
    return {
        "hour_of_day": hour_of_day(ts),
        "day_of_week": day_of_week(ts),
        "month": F.month(ts),
        "is_weekend": is_weekend(ts),
        "is_rush_hour": is_rush_hour(ts),
        "part_of_day": part_of_day(ts),
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "dow_sin": dow_sin,
        "dow_cos": dow_cos,
        "month_sin": month_sin,
        "month_cos": month_cos,
    }
