"""Staging models over the fact table and the weather dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.weather import KMH_SQL, kmh
from ..operators.numbering import with_row_number
from ..schemas import DIM_WEATHER

# Pickup time and zone order the trips; the rest only separates equal pairs.
TRIP_ORDER = [
    "pickup_datetime",
    "pickup_location_id",
    "dropoff_datetime",
    "dropoff_location_id",
    "total_amount",
    "payment_type",
]

# The staged columns and their order.
STAGED_TRIP_COLUMNS = (
    "trip_id",
    "pickup_datetime",
    "dropoff_datetime",
    "trip_duration_minutes",
    "trip_distance",
    "distance_bucket",
    "fare_amount",
    "tip_amount",
    "tip_percentage",
    "total_amount",
    "extra",
    "mta_tax",
    "tolls_amount",
    "passenger_count",
    "payment_type",
    "payment_type_desc",
    "pickup_location_id",
    "dropoff_location_id",
    "pickup_hour",
    "pickup_day_of_week",
    "pickup_date",
    "pickup_month",
    "ingested_at",
    "source_file",
)


def stage_trips(fact: DataFrame) -> DataFrame:
    """The fact table, or some of its columns, with a trip number."""
    numbered = with_row_number(fact, TRIP_ORDER, "trip_id")
    return numbered.select(*(c for c in STAGED_TRIP_COLUMNS if c in numbered.columns))


def stg_weather_sql(table: str) -> str:
    """:func:`stage_weather` as the text of a view over a catalog table."""
    columns = ", ".join(c for c in DIM_WEATHER.names if c != "source_file")
    return f"SELECT {columns}, {KMH_SQL} AS wind_speed_kmh FROM {table} WHERE temp_celsius IS NOT NULL"


def stage_weather(weather: DataFrame) -> DataFrame:
    """The weather dimension with wind in km/h, without its source file."""
    known = weather.filter(F.col("temp_celsius").isNotNull())
    return known.withColumn("wind_speed_kmh", kmh("wind_speed_ms")).drop("source_file")
