"""Complete hour series, and the hours a table lacks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import Settings
from ..functions.time import ntz


def _hours(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))).alias("hour_start")


def period_hours(spark: SparkSession, settings: Settings) -> DataFrame:
    """Every hour of the configured period."""
    last_hour = F.expr("INTERVAL 1 HOUR")
    ranges = [
        spark.range(1).select(_hours(ntz(start), ntz(end) - last_hour))
        for start, end in settings.ranges
    ]
    return reduce(DataFrame.union, ranges)


def observed_hours(hourly: DataFrame, column: str) -> DataFrame:
    """Every hour from the first to the last one present in the table."""
    ends = hourly.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return ends.select(_hours(F.col("first"), F.col("last")))


def missing_hours(spine: DataFrame, hourly: DataFrame, column: str) -> DataFrame:
    """Hours of the series without a row in the table."""
    return spine.join(hourly, F.col("hour_start") == F.col(column), "left_anti")
