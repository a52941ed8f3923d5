"""The nine analytical questions, as queries over the curated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed_values as fv
from ..config import Settings
from ..functions.exact import (
    half_up,
    mean,
    merged_count,
    merged_mean,
    partial,
    pearson,
    percent,
    weight,
    weighted_mean,
    weighted_quantile,
    weighted_stddev,
)
from ..functions.trip import is_peak_hour
from ..operators.joins import from_zones, join_hourly
from ..operators.quantiles import group_quantile
from ..session import written
from .marts import known_weather


def _trips() -> Column:
    return F.count(F.lit(1)).alias("trips")


def _card(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col("payment_type") == fv.CARD_PAYMENT)


def _tipped_card(trips: DataFrame) -> DataFrame:
    return _card(trips).filter((F.col("tip_percentage") > 0) & (F.col("trip_distance") > 0))


def _short(trips: DataFrame) -> DataFrame:
    return trips.filter(F.col("trip_duration_minutes").between(*fv.SHORT_TRIP_MINUTES))


def _busiest(hours: DataFrame, count: str, k: int) -> DataFrame:
    """The k hours with most trips; of equal hours the earlier one."""
    return hours.orderBy(F.desc(count), F.asc("pickup_hour")).limit(k)


# --- Question 1: how long are trips? ------------------------------------------


def _duration_counts(fact: DataFrame) -> DataFrame:
    """Trips per duration: at most 5,901 rows, as durations have two decimals."""
    return _short(fact).groupBy("trip_duration_minutes").agg(weight())


def duration_stats(fact: DataFrame) -> DataFrame:
    duration = "trip_duration_minutes"
    return _duration_counts(fact).agg(
        weighted_quantile(duration, 0.5, 1).alias("median_min"),
        weighted_mean(duration, 1).alias("mean_min"),
        weighted_quantile(duration, 0.75, 1).alias("p75_min"),
    )


def duration_histogram(fact: DataFrame, bins: int = fv.HISTOGRAM_BINS) -> DataFrame:
    """Trips per equal-width bin between the shortest and the longest duration.

    Only the last bin includes its upper edge. Empty bins are not listed.
    """
    duration = "trip_duration_minutes"
    # The counted durations are few, so their limits come from a window over all of them.
    everything = Window.partitionBy()
    limits = _duration_counts(fact).withColumns({
        "_low": F.min(duration).over(everything), "_high": F.max(duration).over(everything)})
    width = (F.col("_high") - F.col("_low")) / bins
    position = F.floor(F.try_divide(F.col(duration) - F.col("_low"), width)) + 1
    # Equal limits leave no width: everything is in the first bin.
    bin_number = F.least(F.coalesce(position, F.lit(1)), F.lit(bins)).cast("int")
    return (
        limits.select(bin_number.alias("bin"), "_rows")
        .groupBy("bin")
        .agg(merged_count().alias("trips"))
        .orderBy("bin")
    )


def bucket_counts(fact: DataFrame) -> DataFrame:
    return fact.groupBy("distance_bucket").agg(_trips()).orderBy("distance_bucket")


def duration_sample(fact: DataFrame, one_in: int = fv.SAMPLE_ONE_IN) -> DataFrame:
    """Some durations for a plot: one trip in so many, chosen by a hash, the same in every run."""
    written = [F.date_format(c, "yyyyMMddHHmmss") for c in ("pickup_datetime", "dropoff_datetime")]
    zones = [F.col(c).cast("string") for c in ("pickup_location_id", "dropoff_location_id")]
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", *written, *zones)), 1, 8), 16, 10).cast("long")
    return _short(fact).filter(digest % one_in == 0).select("trip_duration_minutes")


def duration_sample_of(fact: DataFrame, rows: int = fv.SAMPLE_ROWS) -> DataFrame:
    """Just so many durations for a plot, or all if there are fewer: those of the lowest hash, the same in every run.

    Each task keeps its lowest rows; no more than these reach the last one.
    """
    written = [F.date_format(c, "yyyyMMddHHmmss") for c in ("pickup_datetime", "dropoff_datetime")]
    zones = [F.col(c).cast("string") for c in ("pickup_location_id", "dropoff_location_id")]
    lot = F.md5(F.concat_ws("|", *written, *zones))
    short = _short(fact).select("trip_duration_minutes", lot.alias("_lot"))
    return short.orderBy("_lot", "trip_duration_minutes").limit(rows).select("trip_duration_minutes")


# --- Question 2: do longer trips tip more? -------------------------------------


def tips_by_bucket(fact: DataFrame) -> DataFrame:
    """Mean and median card tip per distance bucket; the trips are read once, for the counts of equal tips."""
    tip = "tip_percentage"
    by_value = written(_card(fact).groupBy("distance_bucket", tip).agg(weight()), "tips-by-bucket")
    figures = by_value.groupBy("distance_bucket").agg(
        weighted_mean(tip, 2).alias("avg_tip_pct"), merged_count().alias("trips"))
    medians = group_quantile(by_value, ["distance_bucket"], tip, 0.5, 2, "median_tip_pct")
    return (
        figures.join(medians, "distance_bucket", "left")
        .select("distance_bucket", "avg_tip_pct", "median_tip_pct", "trips")
        .orderBy("distance_bucket")
    )


def tip_by_mile(fact: DataFrame) -> DataFrame:
    """Average card tip per whole mile."""
    mile = half_up("trip_distance", 0)
    return (
        _card(fact)
        .filter(F.col("trip_distance").between(*fv.SCATTER_MILES) & (F.col("tip_percentage") > 0))
        .groupBy(mile.alias("miles"))
        .agg(mean("tip_percentage", 6).alias("avg_tip"))
        .orderBy("miles")
    )


def tip_correlation(fact: DataFrame) -> DataFrame:
    return _tipped_card(fact).agg(
        pearson("trip_distance", "tip_percentage", 4).alias("correlation")
    )


# --- Question 3: which hours are busiest? --------------------------------------


def trips_by_hour(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("pickup_hour")
        .agg(_trips(), mean("trip_duration_minutes", 1).alias("avg_duration"))
        .withColumn("is_peak", is_peak_hour("pickup_hour"))
        .orderBy("pickup_hour")
    )


def busiest_hours(fact: DataFrame, k: int = 3) -> DataFrame:
    return _busiest(trips_by_hour(fact).drop("is_peak"), "trips", k)


# --- Question 4: distance and tip, per bucket ----------------------------------


def correlation_by_bucket(fact: DataFrame) -> DataFrame:
    return (
        _tipped_card(fact)
        .groupBy("distance_bucket")
        .agg(
            mean("tip_percentage", 2).alias("avg_tip"),
            pearson("trip_distance", "tip_percentage", 4).alias("correlation"),
        )
        .orderBy("distance_bucket")
    )


# --- Question 5: temperature at peak hours -------------------------------------


def temperature_by_hour(fact: DataFrame, weather: DataFrame, settings: Settings) -> DataFrame:
    """Trips and their average temperature per hour of day.

    Trips are counted per date and hour first, so the join sees one row for each
    hour of the period.
    """
    hourly = fact.groupBy("pickup_date", "pickup_hour").agg(weight())
    joined = join_hourly(hourly, weather, settings, "inner")
    return (
        joined.groupBy("pickup_hour")
        .agg(
            merged_count().alias("trips"),
            weighted_mean("temp_celsius", 6).alias("avg_temp"),
        )
        .orderBy("pickup_hour")
    )


def temperature_at_peak(
    fact: DataFrame, weather: DataFrame, settings: Settings, k: int = 3
) -> DataFrame:
    hours = temperature_by_hour(fact, weather, settings)
    return _busiest(hours, "trips", k).withColumn("avg_temp", half_up("avg_temp", 1))


# --- Question 6: does weather change the number of trips? ----------------------


def volume_by_weather(summary: DataFrame) -> DataFrame:
    """Unweighted averages over the hours of the summary."""
    return (
        summary.groupBy("weather_category")
        .agg(
            mean("trip_count", 0).alias("avg_trips_per_hour"),
            mean("avg_tip_pct", 2).alias("avg_tip"),
            mean("avg_temp_celsius", 1).alias("avg_temp"),
            mean("avg_wind_speed_ms", 1).alias("avg_wind_ms"),
            F.count(F.lit(1)).alias("periods"),
        )
        .orderBy(F.desc_nulls_first("avg_trips_per_hour"), "weather_category")
    )


# --- Question 7: behaviour per weather ------------------------------------------


def behaviour_by_weather(enriched: DataFrame) -> DataFrame:
    return (
        known_weather(enriched)
        .groupBy("weather_category")
        .agg(
            _trips(),
            mean("trip_duration_minutes", 1).alias("avg_duration"),
            mean("trip_distance", 2).alias("avg_distance"),
            mean("tip_percentage", 2).alias("avg_tip"),
            mean("fare_amount", 2).alias("avg_fare"),
        )
        .orderBy(F.desc("trips"), "weather_category")
    )


# --- Question 8: when do high-value zones ride? ---------------------------------


def premium_by_hour(enriched: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips, tip and amount per hour of day, from high-value zones.

    Trips are summed per zone and hour before zones are selected, so the join
    sees a few rows per zone and no zone can be too large for it.
    """
    per_zone = enriched.groupBy("pickup_location_id", "pickup_hour").agg(
        weight(), *partial("tip_percentage", "total_amount")
    )
    return (
        from_zones(per_zone, zones)
        .groupBy("pickup_hour")
        .agg(
            merged_count().alias("premium_trips"),
            merged_mean("tip_percentage", 2).alias("avg_tip"),
            merged_mean("total_amount", 2).alias("avg_amount"),
        )
        .orderBy("pickup_hour")
    )


def premium_peak_hour(enriched: DataFrame, zones: DataFrame) -> DataFrame:
    """The hour with most premium trips; of equal hours the earlier one."""
    hours = premium_by_hour(enriched, zones)
    rank = F.struct(F.col("premium_trips"), -F.col("pickup_hour"))
    return hours.agg(F.max_by("pickup_hour", rank).alias("peak_hour"))


def premium_top_hours(enriched: DataFrame, zones: DataFrame, k: int = 5) -> DataFrame:
    return _busiest(premium_by_hour(enriched, zones), "premium_trips", k)


# --- Question 9: does weather change tips? --------------------------------------


def tips_by_weather(enriched: DataFrame) -> DataFrame:
    """Card tips per weather category; trips are read and joined once, for the counts of equal tips."""
    tip = "tip_percentage"
    by_value = written(
        known_weather(_card(enriched)).groupBy("weather_category", tip).agg(weight()), "tips-by-weather")
    untipped = F.sum(F.when(F.col(tip) == 0, F.col("_rows")).otherwise(0))
    figures = by_value.groupBy("weather_category").agg(
        weighted_mean(tip, 2).alias("avg_tip"),
        weighted_stddev(tip, 2).alias("std_tip"),
        percent(untipped, merged_count(), 2).alias("pct_untipped"),
    )
    medians = group_quantile(by_value, ["weather_category"], tip, 0.5, 2, "median_tip")
    return (
        figures.join(medians, "weather_category", "left")
        .select("weather_category", "avg_tip", "median_tip", "std_tip", "pct_untipped")
        .orderBy(F.desc_nulls_first("avg_tip"), "weather_category")
    )
