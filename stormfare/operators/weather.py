"""Weather stages: flatten, filter, keep one observation per hour, statistics.

``flatten`` and ``first_per_hour`` use only operators a stream accepts too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exact import half_up, mean, percent
from ..functions.time import hour_start
from ..functions.weather import category, first_condition
from ..schemas import DIM_WEATHER


def flatten(raw: DataFrame, *carried: str) -> DataFrame:
    """Nested observation to flat columns, and the ``carried`` ones as they are.

    A timestamp that cannot be read becomes NULL; :func:`valid` drops its row.
    ``observation_id`` is kept to decide between observations of one moment.
    """
    source = F.col("source_file") if "source_file" in raw.columns else F.input_file_name()
    observed = raw.withColumn(
        "observation_ts", F.col("`_metadata`.collected_at_iso").try_cast("timestamp_ntz")
    )
    return observed.select(
        F.col("observation_ts"),
        hour_start("observation_ts").alias("observation_hour"),
        half_up("main.temp", 1).alias("temp_celsius"),
        half_up("main.feels_like", 1).alias("temp_feels_like"),
        F.col("main.humidity").try_cast("int").alias("humidity_pct"),
        half_up("wind.speed", 2).alias("wind_speed_ms"),
        F.col("wind.deg").try_cast("int").alias("wind_direction_deg"),
        first_condition("main").alias("weather_main"),
        first_condition("description").alias("weather_description"),
        category(
            F.col("`_metadata`.weather_category"), first_condition("main")
        ).alias("weather_category"),
        F.col("main.pressure").try_cast("int").alias("pressure_hpa"),
        F.col("visibility").try_cast("int").alias("visibility_m"),
        F.hour("observation_ts").alias("obs_hour"),
        F.dayofweek("observation_ts").alias("obs_day_of_week"),
        F.to_date("observation_ts").alias("obs_date"),
        F.current_timestamp().alias("ingested_at"),
        source.alias("source_file"),
        F.col("id").cast("long").alias("observation_id"),
        *(F.col(c) for c in carried),
    )


def usable() -> Column:
    """Whether a flat observation has a moment and a temperature."""
    return F.col("observation_ts").isNotNull() & F.col("temp_celsius").isNotNull()


def valid(observations: DataFrame) -> DataFrame:
    """Observations with a moment and a temperature."""
    return observations.filter(usable())


def first_per_hour(observations: DataFrame) -> DataFrame:
    """One observation per hour: the earliest, then the lowest id.

    The remaining columns break further ties, so the survivor does not depend on
    arrival order. The minimum is taken in every task before the shuffle: an
    hour that holds most of the rows sends one row per task.
    """
    rest = [
        c
        for c in observations.columns
        if c not in ("observation_ts", "observation_id", "observation_hour", "ingested_at")
    ]
    survivor = F.min(F.struct("observation_ts", "observation_id", *rest, "ingested_at"))
    return (
        observations.groupBy("observation_hour")
        .agg(survivor.alias("first"))
        .select("observation_hour", "first.*")
        .select(*observations.columns)
    )


def dim_weather(raw: DataFrame) -> DataFrame:
    """From nested observations to the hourly dimension."""
    return DIM_WEATHER.conform(raw.transform(flatten).transform(valid).transform(first_per_hour))


def dedup_report(raw: DataFrame) -> DataFrame:
    """Observations before, after and dropped by the hourly selection.

    Counting distinct hours is enough; nothing needs to be selected.
    """
    observations = raw.transform(flatten).transform(valid)
    counted = observations.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_distinct("observation_hour").alias("rows_out"),
    )
    return counted.withColumn("duplicates", F.col("rows_in") - F.col("rows_out"))


def category_counts(weather: DataFrame) -> DataFrame:
    return (
        weather.groupBy("weather_category")
        .agg(F.count(F.lit(1)).alias("observations"))
        .orderBy(F.desc("observations"), F.asc_nulls_last("weather_category"))
    )


def category_share(weather: DataFrame) -> DataFrame:
    """Each category's percentage of all observations, largest first."""
    counts = weather.groupBy("weather_category").agg(F.count(F.lit(1)).alias("observations"))
    everything = counts.agg(F.sum("observations")).scalar()
    return counts.withColumn(
        "share_pct", percent(F.col("observations"), everything, 1)
    ).orderBy(F.desc("observations"), F.asc_nulls_last("weather_category"))


def global_stats(weather: DataFrame) -> DataFrame:
    """One row of temperature, humidity and wind figures."""
    return weather.agg(
        mean("temp_celsius", 1).alias("avg_temp_c"),
        half_up(F.min("temp_celsius"), 1).alias("min_temp_c"),
        half_up(F.max("temp_celsius"), 1).alias("max_temp_c"),
        mean("humidity_pct", 0).alias("avg_humidity_pct"),
        mean("wind_speed_ms", 1).alias("avg_wind_ms"),
    )
