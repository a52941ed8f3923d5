"""Mergeable summaries per hour and zone, for figures over any period without the trips.

A summary has a fixed size whatever its trips, so a year of hours and zones is
read instead of the fact table. Figures from it are estimates:

* distinct values, with HyperLogLog sketches of 2**12 registers: a relative
  standard error of 1.6 %, less for few values;
* quantiles, with KLL sketches of k = 400: the rank of the value given is within
  0.8 % of the wanted one in 99 of 100 cases.

Merging keeps these errors. The exact figures stay where they are; these are for
periods too long to read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HLL_LOG_REGISTERS = 12
KLL_K = 400
#: Three standard errors of distinct counts, and twice the rank error of quantiles.
DISTINCT_ERROR, RANK_ERROR = 0.049, 0.016
HOUR_AND_ZONE = ["pickup_date", "pickup_hour", "pickup_location_id"]


def summarize(trips: DataFrame, distinct: str, measured: str, keys: list[str] | None = None) -> DataFrame:
    """One row per key: rows, a sketch of distinct values of one column, one of the distribution of another."""
    # In cents and the like: a sketch hashes whole numbers alike everywhere.
    value = F.rint(F.col(distinct) * 100).cast("long")
    return trips.groupBy(*(keys or HOUR_AND_ZONE)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.hll_sketch_agg(value, HLL_LOG_REGISTERS).alias("distinct_sketch"),
        F.kll_sketch_agg_double(F.col(measured).cast("double"), KLL_K).alias("value_sketch"))


def merged(summaries: DataFrame, keys: list[str], quantile: float | Column = 0.5) -> DataFrame:
    """Rows, distinct values and a quantile of coarser keys, from summaries alone."""
    rank = F.lit(quantile) if isinstance(quantile, float) else quantile
    found = summaries.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.hll_union_agg("distinct_sketch").alias("_distinct"),
        F.kll_merge_agg_double("value_sketch").alias("_values"))
    return found.select(
        *keys, "rows", F.hll_sketch_estimate("_distinct").alias("distinct_values"),
        F.kll_sketch_get_quantile_double("_values", rank).alias("quantile"))
