"""Date-partitioned folders, so a reader opens only the months or days it wants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Settings

PARTITIONS = ("year", "month", "day")


def with_partitions(df: DataFrame, ts: str, levels: int = 3) -> DataFrame:
    """Add year, month and day columns taken from a timestamp column."""
    parts = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    return df.withColumns({name: parts[name] for name in PARTITIONS[:levels]})


def write_by_date(df: DataFrame, path: str, ts: str, levels: int = 3, fmt: str = "parquet") -> None:
    """Write below ``year=/month=/day=`` folders.

    Rebalancing gathers each date into few files and splits a date that is much
    larger than the others.
    """
    names = PARTITIONS[:levels]
    dated = with_partitions(df, ts, levels).hint("rebalance", *names)
    dated.write.mode("overwrite").partitionBy(*names).format(fmt).save(path)


def in_months(settings: Settings) -> Column:
    """Condition on the partition columns that keeps the months of the period."""
    tests = [(F.col("year") == y) & (F.col("month") == m) for y, m in settings.month_parts]
    return reduce(lambda a, b: a | b, tests)


def month_folders(base: str, settings: Settings, plain: bool) -> list[tuple[str, str]]:
    """``(YYYY-MM, folder)`` of every month.

    ``plain`` is the layout ``2024/01``; otherwise ``year=2024/month=1``.
    """
    shape = "{base}/{y}/{m:02d}" if plain else "{base}/year={y}/month={m}"
    return [
        (label, shape.format(base=base.rstrip("/"), y=y, m=m))
        for label, (y, m) in zip(settings.month_labels, settings.month_parts)
    ]
