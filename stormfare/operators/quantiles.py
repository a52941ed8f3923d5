"""Exact quantiles of values whose number of distinct values has no known limit.

``weighted_quantile`` keeps the distinct values of a group in memory, which suits
durations with their fixed range. Here the rows of a group are first counted per
whole number, which tells the one or two bins that hold the wanted ranks; only
the values of these bins are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.exact import WEIGHT, half_up

_UNBOUNDED = (Window.unboundedPreceding, Window.currentRow)


def group_quantile(counts: DataFrame, keys: list[str], value: str, q: float, places: int,
                   name: str) -> DataFrame:
    """Interpolated quantile of each group, from one row per key and value with its frequency.

    Values that are NULL do not count; a group without any has no row.
    """
    binned = counts.filter(F.col(value).isNotNull()).withColumn("_bin", F.floor(value))
    bins = binned.groupBy(*keys, "_bin").agg(F.sum(WEIGHT).alias("_rows_in"))
    group = Window.partitionBy(*keys)
    placed = bins.withColumns({
        "_to": F.sum("_rows_in").over(group.orderBy("_bin").rowsBetween(*_UNBOUNDED)),
        "_all": F.sum("_rows_in").over(group),
    }).withColumn("_before", F.col("_to") - F.col("_rows_in"))
    position = (F.col("_all") - 1) * q

    def holds(rank: Column) -> Column:
        return (F.col("_before") <= rank) & (F.col("_to") > rank)

    wanted = placed.filter(holds(F.floor(position)) | holds(F.ceil(position))).select(
        *keys, "_bin", "_before", "_all")
    inside = Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(*_UNBOUNDED)
    ranked = binned.join(wanted, [*keys, "_bin"]).withColumn(
        "_up_to", F.col("_before") + F.sum(WEIGHT).over(inside))

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_up_to") > rank, F.col(value)))

    low, high = at(F.floor(position)), at(F.ceil(position))
    fraction = F.max(position - F.floor(position))
    return ranked.groupBy(*keys).agg(half_up(low + (high - low) * fraction, places).alias(name))
