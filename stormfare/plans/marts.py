"""Mart models: enriched trips, the hourly summary and the high-value zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import fixed_values as fv
from ..config import Settings
from ..functions.exact import (
    UNIT,
    WEIGHT,
    merged_count,
    merged_mean,
    merged_total,
    partial,
    weight,
    weighted_mean,
    weighted_quantile,
)
from ..operators.joins import join_hourly
from ..schemas import HIGH_VALUE_ZONES, TRIP_ENRICHED, TRIP_SUMMARY


def enrich_trips(trips: DataFrame, weather: DataFrame, settings: Settings) -> DataFrame:
    """Every trip with the weather of its pickup hour.

    Trips of an hour without weather stay, in the category of unknown weather.
    ``trips`` may be the fact table or its numbered staging form; the number is
    only carried along where it is there.
    """
    joined = join_hourly(trips, weather, settings, "left").withColumn(
        "weather_category", F.coalesce("weather_category", F.lit(fv.UNKNOWN_WEATHER))
    )
    if "trip_id" in trips.columns:
        return TRIP_ENRICHED.conform(joined)
    return joined.select(*(n for n in TRIP_ENRICHED.names if n != "trip_id"))


def known_weather(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("weather_category") != fv.UNKNOWN_WEATHER)


def trip_summary(enriched: DataFrame) -> DataFrame:
    """Trips, averages, median duration and revenue per hour, date and weather.

    Durations have two decimals between fixed limits, so the second step sees at
    most about 18,000 rows for any hour, however many trips it had.
    """
    keys = ["pickup_hour", "pickup_date", "weather_category"]
    carried = [
        "tip_percentage", "fare_amount", "total_amount", "trip_distance",
        "temp_celsius", "wind_speed_ms", "humidity_pct",
    ]
    duration = "trip_duration_minutes"
    by_duration = (
        known_weather(enriched).groupBy(*keys, duration).agg(weight(), *partial(*carried))
    )
    summary = by_duration.groupBy(*keys).agg(
        merged_count().alias("trip_count"),
        weighted_mean(duration, 1).alias("avg_duration_min"),
        weighted_quantile(duration, 0.5, 1).alias("median_duration_min"),
        merged_mean("tip_percentage", 2).alias("avg_tip_pct"),
        merged_mean("fare_amount", 2).alias("avg_fare"),
        merged_total("total_amount", 2).alias("total_revenue"),
        merged_mean("trip_distance", 2).alias("avg_distance_miles"),
        merged_mean("temp_celsius", 1).alias("avg_temp_celsius"),
        merged_mean("wind_speed_ms", 1).alias("avg_wind_speed_ms"),
        merged_mean("humidity_pct", 0).alias("avg_humidity_pct"),
    )
    return TRIP_SUMMARY.conform(summary).orderBy("pickup_date", "pickup_hour")


def high_value_zones(enriched: DataFrame) -> DataFrame:
    """Pickup zones whose card trips are many, lucrative and well tipped.

    The criteria look at unrounded figures; the order at the rounded total.
    """
    zone = "pickup_location_id"
    carried = ["total_amount", "fare_amount", "tip_percentage", "trip_distance", "trip_duration_minutes"]
    # Trips are read once and summed per zone, date and category, then per zone and category, then per zone.
    by_day = (
        enriched.filter(F.col("payment_type") == fv.CARD_PAYMENT)
        .groupBy(zone, "pickup_date", "weather_category").agg(weight(), *partial(*carried))
    )
    # A date counts with the first of its categories.
    place = F.row_number().over(Window.partitionBy(zone, "pickup_date").orderBy("weather_category"))
    dated = by_day.withColumn("_days", ((place == 1) & F.col("pickup_date").isNotNull()).cast("long"))
    sums = [c for c in dated.columns if c.startswith("_")]
    by_category = dated.groupBy(zone, "weather_category").agg(*(F.sum(c).alias(c) for c in sums))
    seen = F.when(F.col("weather_category").isNotNull(), F.struct(
        -F.col(WEIGHT), F.col("weather_category").alias("label")))
    figures = by_category.groupBy(zone).agg(
        merged_count().alias("trip_count"),
        F.sum("_days").alias("active_days"),
        merged_total("total_amount", 2).alias("total_spent"),
        merged_mean("fare_amount", 2).alias("avg_fare"),
        merged_mean("tip_percentage", 2).alias("avg_tip_pct"),
        merged_mean("total_amount", 2).alias("avg_total_per_trip"),
        merged_mean("trip_distance", 2).alias("avg_distance_miles"),
        merged_mean("trip_duration_minutes", 1).alias("avg_duration_min"),
        # Of equally frequent categories the first by name.
        F.min(seen).alias("_most"),
        F.sum("_sum_total_amount").alias("_spent"),
        # The average as sum > limit * count: no division, so no rounding.
        F.sum("_sum_tip_percentage").alias("_tips"),
        (F.sum("_n_tip_percentage") * (fv.ZONE_MIN_TIP_PCT * UNIT)).alias("_tips_floor"),
    )
    zones = (
        figures.withColumn("dominant_weather", F.col("_most.label"))
        .filter(
            (F.col("trip_count") >= fv.ZONE_MIN_TRIPS)
            & (F.col("_spent") > fv.ZONE_MIN_SPENT * UNIT)
            & (F.col("_tips") > F.col("_tips_floor"))
        )
    )
    return HIGH_VALUE_ZONES.conform(zones).orderBy(
        F.desc_nulls_first("total_spent"), F.asc_nulls_last("pickup_location_id")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, one row per table."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, table in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.union(other)
    return result
