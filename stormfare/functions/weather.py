"""Derived weather columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import fixed_values as fv
from .exact import half_up


def first_condition(field: str) -> Column:
    """A field of the first listed condition; NULL for an empty list."""
    return F.get("weather", F.lit(0)).getField(field)


def category(given: Column, condition: Column) -> Column:
    """The feed's own category, else one derived from the condition."""
    derived = F.lit(fv.OTHER_WEATHER)
    for label, conditions in fv.WEATHER_FALLBACK.items():
        derived = F.when(condition.isin(*conditions), label).otherwise(derived)
    return F.coalesce(given, derived)


#: :func:`kmh` of ``wind_speed_ms`` as SQL text, for views.
KMH_SQL = f"round(CAST(rint(wind_speed_ms * {fv.KMH_PER_MS}D * 1e6D) AS BIGINT), -5) / 1e6D"


def kmh(metres_per_second: str) -> Column:
    return half_up(F.col(metres_per_second) * fv.KMH_PER_MS, 1)
