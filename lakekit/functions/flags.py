"""Two-valued quality flags: a flag means "we know this row has this problem"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def two_valued(pred: Column) -> Column:
    """``COALESCE(pred, false)`` — never null, so ``NOT flag`` cannot silently drop rows."""
    return F.coalesce(pred, F.lit(False))


def not_true(pred: Column) -> Column:
    """``pred IS NOT TRUE`` (null counts as not true)."""
    return ~two_valued(pred)


def with_flags(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Add declarative flags, each made two-valued."""
    return df.withColumns({name: two_valued(pred) for name, pred in flags.items()})


def trip_quality_flags(fare="fare_amount_usd", distance="trip_distance_miles", pickup="pickup_datetime_local",
                       dropoff="dropoff_datetime_local", duration="trip_duration_seconds",
                       passengers="passenger_count", max_duration_s: int = 86400,
                       max_passengers: int = 8) -> dict[str, Column]:
    """The six Silver flags of a trip row."""
    p = F.col(passengers)
    return {
        "negative_fare_flag": F.col(fare) < 0,
        "negative_distance_flag": F.col(distance) < 0,
        "dropoff_before_pickup_flag": F.col(dropoff) < F.col(pickup),
        "implausible_duration_flag": (F.col(duration) <= 0) | (F.col(duration) > max_duration_s),
        "implausible_passenger_count_flag": (p < 0) | (p > max_passengers),
        "passenger_count_missing_flag": p.isNull() | (p == 0),
    }
