"""Trip stages: clean, enrich, add time dimensions, standardise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..config import Settings
from ..functions.exact import percent
from ..functions.time import in_period
from ..functions.trip import distance_bucket, duration_minutes, payment_label, tip_percentage
from ..schemas import FACT_TRIPS


def cleaning_rules(settings: Settings) -> dict[str, Column]:
    """Named conditions a raw trip must meet. NULL means not met."""
    c = F.col
    return {
        "pickup_known": c("tpep_pickup_datetime").isNotNull(),
        "dropoff_known": c("tpep_dropoff_datetime").isNotNull(),
        "distance_in_range": c("trip_distance").between(
            settings.min_distance, settings.max_distance
        ),
        "fare_in_range": c("fare_amount").between(settings.min_fare, settings.max_fare),
        "passengers_in_range": c("passenger_count").between(
            settings.min_passengers, settings.max_passengers
        ),
        "pickup_in_period": in_period("tpep_pickup_datetime", settings.ranges),
        "dropoff_after_pickup": c("tpep_dropoff_datetime") > c("tpep_pickup_datetime"),
    }


def _all_met(rules: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, rules.values())


def clean(trips: DataFrame, settings: Settings) -> DataFrame:
    """Keep only valid trips; nothing is repaired."""
    return trips.filter(_all_met(cleaning_rules(settings)))


def _reject_counts(rules: dict[str, Column]) -> list[Column]:
    broken = [
        F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"not_{name}")
        for name, rule in rules.items()
    ]
    kept = F.count_if(F.coalesce(_all_met(rules), F.lit(False)))
    return [F.count(F.lit(1)).alias("rows_in"), kept.alias("rows_out"), *broken]


def reject_report(trips: DataFrame, settings: Settings) -> DataFrame:
    """Rows in, out and rejected, and rows breaking each rule, in one scan."""
    counted = trips.agg(*_reject_counts(cleaning_rules(settings)))
    rejected = F.col("rows_in") - F.col("rows_out")
    return counted.withColumns({
        "rows_rejected": rejected,
        "pct_rejected": F.coalesce(percent(rejected, F.col("rows_in"), 2), F.lit(0.0)),
    })


def clean_observed(trips: DataFrame, settings: Settings, metrics: Observation) -> DataFrame:
    """:func:`clean`, with the reject counts gathered by the job that uses it."""
    counts = _reject_counts(cleaning_rules(settings))
    return clean(trips.observe(metrics, *counts), settings)


def enrich(trips: DataFrame, settings: Settings) -> DataFrame:
    """Add duration, tip percentage, distance bucket and payment label.

    Trips whose rounded duration is out of range drop here.
    """
    timed = trips.withColumn(
        "trip_duration_minutes",
        duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime"),
    ).filter(
        F.col("trip_duration_minutes").between(settings.min_duration, settings.max_duration)
    )
    return timed.withColumns({
        "tip_percentage": tip_percentage("tip_amount", "fare_amount"),
        "distance_bucket": distance_bucket("trip_distance"),
        "payment_type_desc": payment_label("payment_type"),
    })


def add_time_dimensions(trips: DataFrame) -> DataFrame:
    """Add calendar columns of the pickup, load time and source file.

    ``pickup_day_of_week`` counts from 1 = Sunday.
    """
    pickup = "tpep_pickup_datetime"
    source = F.col("source_file") if "source_file" in trips.columns else F.input_file_name()
    return trips.withColumns({
        "pickup_hour": F.hour(pickup),
        "pickup_day_of_week": F.dayofweek(pickup),
        "pickup_date": F.to_date(pickup),
        "pickup_month": F.month(pickup),
        "ingested_at": F.current_timestamp(),
        "source_file": source,
    })


def standardize(trips: DataFrame) -> DataFrame:
    """Warehouse names, types and column order."""
    renamed = trips.withColumnsRenamed({
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
        "PULocationID": "pickup_location_id",
        "DOLocationID": "dropoff_location_id",
    })
    return FACT_TRIPS.conform(renamed)


def fact_trips(cleaned: DataFrame, settings: Settings) -> DataFrame:
    """From cleaned trips to the fact table."""
    return (
        cleaned.transform(enrich, settings)
        .transform(add_time_dimensions)
        .transform(standardize)
    )
