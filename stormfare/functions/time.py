"""Wall-clock expressions that never pass through the session time zone."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, functions as F


def ntz(moment: datetime) -> Column:
    """A literal without zone: a plain datetime would become a zoned one, and
    comparing with it would cast the column and lose the scan's pushed filter."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def hour_start(ts: str) -> Column:
    """Start of the hour of a zone-less timestamp.

    ``date_trunc`` answers with a zoned timestamp, which shifts wall-clock hours
    that do not exist in the session zone.
    """
    return F.timestamp_add("HOUR", F.hour(ts), F.to_date(ts).cast("timestamp_ntz"))


def in_period(ts: str, ranges: tuple[tuple[datetime, datetime], ...]) -> Column:
    """Half-open range test, which the Parquet scan can use; year()/month() cannot."""
    tests = [(F.col(ts) >= ntz(start)) & (F.col(ts) < ntz(end)) for start, end in ranges]
    return reduce(lambda a, b: a | b, tests)


def iso_weekday(ts: str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(ts) + 1
