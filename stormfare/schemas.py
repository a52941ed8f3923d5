"""Column contracts of the raw feeds and the curated tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

_NTZ = T.TimestampNTZType()
_LTZ = T.TimestampType()
_INT = T.IntegerType()
_LONG = T.LongType()
_DOUBLE = T.DoubleType()
_STR = T.StringType()
_DATE = T.DateType()

RAW_TRIPS = T.StructType([
    T.StructField("tpep_pickup_datetime", _NTZ),
    T.StructField("tpep_dropoff_datetime", _NTZ),
    T.StructField("trip_distance", _DOUBLE),
    T.StructField("fare_amount", _DOUBLE),
    T.StructField("extra", _DOUBLE),
    T.StructField("mta_tax", _DOUBLE),
    T.StructField("tip_amount", _DOUBLE),
    T.StructField("tolls_amount", _DOUBLE),
    T.StructField("total_amount", _DOUBLE),
    T.StructField("passenger_count", _LONG),
    T.StructField("payment_type", _LONG),
    T.StructField("PULocationID", _INT),
    T.StructField("DOLocationID", _INT),
])

CORRUPT_COLUMN = "_corrupt_record"

RAW_WEATHER = T.StructType([
    T.StructField("coord", T.StructType([
        T.StructField("lon", _DOUBLE),
        T.StructField("lat", _DOUBLE),
    ])),
    T.StructField("base", _STR),
    T.StructField("dt", _LONG),
    T.StructField("timezone", _INT),
    T.StructField("id", _LONG),
    T.StructField("name", _STR),
    T.StructField("cod", _INT),
    T.StructField("weather", T.ArrayType(T.StructType([
        T.StructField("id", _INT),
        T.StructField("main", _STR),
        T.StructField("description", _STR),
        T.StructField("icon", _STR),
    ]))),
    T.StructField("main", T.StructType([
        T.StructField("temp", _DOUBLE),
        T.StructField("feels_like", _DOUBLE),
        T.StructField("temp_min", _DOUBLE),
        T.StructField("temp_max", _DOUBLE),
        T.StructField("pressure", _INT),
        T.StructField("humidity", _INT),
    ])),
    T.StructField("visibility", _INT),
    T.StructField("wind", T.StructType([
        T.StructField("speed", _DOUBLE),
        T.StructField("deg", _INT),
    ])),
    T.StructField("clouds", T.StructType([T.StructField("all", _INT)])),
    T.StructField("sys", T.StructType([
        T.StructField("country", _STR),
        T.StructField("sunrise", _LONG),
        T.StructField("sunset", _LONG),
    ])),
    T.StructField("_metadata", T.StructType([
        T.StructField("collected_at_iso", _STR),
        T.StructField("collected_at_ts", _LONG),
        T.StructField("city_id", _INT),
        T.StructField("city_name", _STR),
        T.StructField("pipeline_version", _STR),
        T.StructField("simulated", T.BooleanType()),
        T.StructField("weather_category", _STR),
    ])),
])


@dataclass(frozen=True)
class Contract:
    """What a table promises: columns in order, required ones, text widths."""

    name: str
    columns: tuple[tuple[str, T.DataType], ...]
    required: tuple[str, ...] = ()
    max_length: tuple[tuple[str, int], ...] = ()

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.columns]

    def conform(self, df: DataFrame) -> DataFrame:
        """Project to exactly the promised columns, order and types."""
        missing = [name for name in self.names if name not in df.columns]
        if missing:
            raise ValueError(f"{self.name}: missing columns {missing}")
        return df.select(*(F.col(name).cast(dtype).alias(name) for name, dtype in self.columns))

    def violations(self) -> list[Column]:
        """One aggregate per promise, counting the rows that break it."""
        nulls = [F.count_if(F.col(c).isNull()).alias(f"{c}__null") for c in self.required]
        wide = [
            F.count_if(F.length(c) > width).alias(f"{c}__too_long")
            for c, width in self.max_length
        ]
        return nulls + wide

    def enforce(self, df: DataFrame) -> DataFrame:
        """Conform, and fail the running write on the first broken row."""
        checks = [(F.col(c).isNotNull(), f"{c} is null") for c in self.required]
        checks += [
            (F.col(c).isNull() | (F.length(c) <= width), f"{c} is longer than {width}")
            for c, width in self.max_length
        ]
        problem = reduce(
            lambda rest, check: F.when(~check[0], F.lit(check[1])).otherwise(rest),
            reversed(checks),
            F.lit(None).cast("string"),
        )
        message = F.concat(F.lit(f"{self.name}: "), problem)
        passed = F.when(problem.isNull(), F.lit(True)).otherwise(
            F.raise_error(message).cast("boolean")
        )
        return self.conform(df).filter(passed)


FACT_TRIPS = Contract(
    "fact_trips",
    (
        ("pickup_datetime", _NTZ),
        ("dropoff_datetime", _NTZ),
        ("trip_duration_minutes", _DOUBLE),
        ("trip_distance", _DOUBLE),
        ("distance_bucket", _STR),
        ("fare_amount", _DOUBLE),
        ("extra", _DOUBLE),
        ("mta_tax", _DOUBLE),
        ("tip_amount", _DOUBLE),
        ("tolls_amount", _DOUBLE),
        ("total_amount", _DOUBLE),
        ("tip_percentage", _DOUBLE),
        ("passenger_count", _INT),
        ("payment_type", _INT),
        ("payment_type_desc", _STR),
        ("pickup_location_id", _INT),
        ("dropoff_location_id", _INT),
        ("pickup_hour", _INT),
        ("pickup_day_of_week", _INT),
        ("pickup_date", _DATE),
        ("pickup_month", _INT),
        ("ingested_at", _LTZ),
        ("source_file", _STR),
    ),
    required=("pickup_datetime", "dropoff_datetime"),
    max_length=(("distance_bucket", 10), ("payment_type_desc", 20), ("source_file", 255)),
)

DIM_WEATHER = Contract(
    "dim_weather",
    (
        ("observation_ts", _NTZ),
        ("observation_hour", _NTZ),
        ("temp_celsius", _DOUBLE),
        ("temp_feels_like", _DOUBLE),
        ("humidity_pct", _INT),
        ("wind_speed_ms", _DOUBLE),
        ("wind_direction_deg", _INT),
        ("weather_main", _STR),
        ("weather_description", _STR),
        ("weather_category", _STR),
        ("pressure_hpa", _INT),
        ("visibility_m", _INT),
        ("obs_hour", _INT),
        ("obs_day_of_week", _INT),
        ("obs_date", _DATE),
        ("ingested_at", _LTZ),
        ("source_file", _STR),
    ),
    required=("observation_ts", "observation_hour"),
    max_length=(
        ("weather_main", 50),
        ("weather_description", 100),
        ("weather_category", 20),
        ("source_file", 255),
    ),
)

TRIP_ENRICHED = Contract(
    "trip_enriched",
    (
        ("trip_id", _LONG),
        ("pickup_datetime", _NTZ),
        ("dropoff_datetime", _NTZ),
        ("trip_duration_minutes", _DOUBLE),
        ("trip_distance", _DOUBLE),
        ("distance_bucket", _STR),
        ("fare_amount", _DOUBLE),
        ("tip_amount", _DOUBLE),
        ("tip_percentage", _DOUBLE),
        ("total_amount", _DOUBLE),
        ("passenger_count", _INT),
        ("payment_type", _INT),
        ("payment_type_desc", _STR),
        ("pickup_location_id", _INT),
        ("dropoff_location_id", _INT),
        ("pickup_hour", _INT),
        ("pickup_day_of_week", _INT),
        ("pickup_date", _DATE),
        ("pickup_month", _INT),
        ("temp_celsius", _DOUBLE),
        ("temp_feels_like", _DOUBLE),
        ("humidity_pct", _INT),
        ("wind_speed_ms", _DOUBLE),
        ("wind_speed_kmh", _DOUBLE),
        ("weather_main", _STR),
        ("weather_description", _STR),
        ("weather_category", _STR),
    ),
    required=("trip_id", "pickup_datetime", "weather_category"),
)

TRIP_SUMMARY = Contract(
    "trip_summary_per_hour",
    (
        ("pickup_hour", _INT),
        ("pickup_date", _DATE),
        ("weather_category", _STR),
        ("trip_count", _LONG),
        ("avg_duration_min", _DOUBLE),
        ("median_duration_min", _DOUBLE),
        ("avg_tip_pct", _DOUBLE),
        ("avg_fare", _DOUBLE),
        ("total_revenue", _DOUBLE),
        ("avg_distance_miles", _DOUBLE),
        ("avg_temp_celsius", _DOUBLE),
        ("avg_wind_speed_ms", _DOUBLE),
        ("avg_humidity_pct", _DOUBLE),
    ),
    required=("pickup_hour", "pickup_date", "trip_count"),
)

HIGH_VALUE_ZONES = Contract(
    "high_value_customers",
    (
        ("pickup_location_id", _INT),
        ("trip_count", _LONG),
        ("active_days", _LONG),
        ("total_spent", _DOUBLE),
        ("avg_fare", _DOUBLE),
        ("avg_tip_pct", _DOUBLE),
        ("avg_total_per_trip", _DOUBLE),
        ("avg_distance_miles", _DOUBLE),
        ("avg_duration_min", _DOUBLE),
        ("dominant_weather", _STR),
    ),
    required=("trip_count", "total_spent"),
)
