"""Joins of trips with hourly weather and with selected zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import Settings
from ..functions.time import in_period


def join_hourly(trips: DataFrame, weather: DataFrame, settings: Settings, how: str) -> DataFrame:
    """Give each trip the weather of its pickup hour.

    The key is (date, hour), which both sides already carry, instead of a
    truncated timestamp. ``weather`` must have one row per hour, which the
    uniqueness test of the dimension proves before the marts are built. No hint:
    the size of the weather decides, by statistics or at run time, whether it
    is broadcast, and adaptive execution splits hot hours of a shuffle join.
    """
    same_hour = (F.col("pickup_date") == F.col("obs_date")) & (
        F.col("pickup_hour") == F.col("obs_hour")
    )
    hours = weather.filter(in_period("observation_hour", settings.ranges))
    return trips.join(hours, same_hour, how)


def from_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Rows whose pickup zone is listed; no column of ``zones`` is needed.

    No hint: adaptive execution sees the real size of ``zones`` and decides.
    """
    return trips.join(zones.select("pickup_location_id"), "pickup_location_id", "left_semi")
