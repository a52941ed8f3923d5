"""Derived trip columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv
from .exact import half_up


def duration_minutes(start: str, end: str) -> Column:
    """Minutes between two timestamps; parts of a second are dropped first."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return half_up(seconds / F.lit(60.0), 2)


def tip_percentage(tip: str, fare: str) -> Column:
    """Tip as a percentage of the fare, 0 without a fare, NULL without a tip figure."""
    ratio = F.try_divide(F.col(tip), F.col(fare)) * 100
    return F.when(F.col(fare) > 0, half_up(ratio, 2)).otherwise(F.lit(0.0))


def distance_bucket(miles: str) -> Column:
    """Short, middle or long trip. A NULL distance counts as long."""
    km = F.col(miles) * fv.KM_PER_MILE
    (short_km, short), (middle_km, middle) = fv.DISTANCE_BUCKETS
    return (
        F.when(km < short_km, short)
        .when(km < middle_km, middle)
        .otherwise(fv.LONG_DISTANCE_BUCKET)
    )


def payment_label(code: str) -> Column:
    """Label of a payment code, NULL for a code without one."""
    pairs = [F.lit(v) for item in fv.PAYMENT_LABELS.items() for v in item]
    return F.create_map(*pairs)[F.col(code).cast("int")]


def is_peak_hour(hour: str) -> Column:
    return F.col(hour).isin(*fv.PEAK_HOURS)
