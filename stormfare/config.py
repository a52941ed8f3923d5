"""Job parameters, passed explicitly to every transform that needs them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta

from . import fixed_values as fv


def parse_months(text: str) -> tuple[int, ...]:
    """Turn ``"1, 02,3"`` into ``(1, 2, 3)``."""
    return tuple(int(part) for part in text.split(",") if part.strip())


def _month_start(year: int, month: int) -> datetime:
    return datetime(year + (month - 1) // 12, (month - 1) % 12 + 1, 1)


@dataclass(frozen=True)
class Settings:
    """Period, cleaning thresholds and paths of one run.

    The months drive both which directories are read and which trips survive
    cleaning, so the two can never disagree.
    """

    year: int = fv.YEAR
    months: tuple[int, ...] = fv.MONTHS
    min_distance: float = fv.MIN_TRIP_DISTANCE
    max_distance: float = fv.MAX_TRIP_DISTANCE
    min_fare: float = fv.MIN_FARE_AMOUNT
    max_fare: float = fv.MAX_FARE_AMOUNT
    min_passengers: int = fv.MIN_PASSENGER_COUNT
    max_passengers: int = fv.MAX_PASSENGER_COUNT
    min_duration: float = fv.MIN_DURATION_MINUTES
    max_duration: float = fv.MAX_DURATION_MINUTES
    min_fact_rows: int = fv.MIN_FACT_ROWS
    min_weather_rows: int = fv.MIN_WEATHER_ROWS
    trip_path: str | None = None
    weather_path: str | None = None
    warehouse: str | None = None

    def __post_init__(self) -> None:
        if not self.months:
            raise ValueError("at least one month is needed")
        # A month past 12 runs into the next year, so a period may span years.
        if min(self.months) < 1:
            raise ValueError(f"months start at 1: {self.months}")

    @property
    def month_labels(self) -> tuple[str, ...]:
        """``YYYY-MM`` of every month in the period."""
        return tuple(_month_start(self.year, m).strftime("%Y-%m") for m in self.months)

    @property
    def month_parts(self) -> tuple[tuple[int, int], ...]:
        """``(year, month)`` pairs, the values of the partition directories."""
        starts = (_month_start(self.year, m) for m in self.months)
        return tuple((s.year, s.month) for s in starts)

    @property
    def ranges(self) -> tuple[tuple[datetime, datetime], ...]:
        """Half-open date ranges; adjoining months are one range."""
        merged: list[list[datetime]] = []
        for month in sorted(set(self.months)):
            start, end = _month_start(self.year, month), _month_start(self.year, month + 1)
            if merged and merged[-1][1] == start:
                merged[-1][1] = end
            else:
                merged.append([start, end])
        return tuple((start, end) for start, end in merged)

    @property
    def hours(self) -> int:
        """Hours in the period: the most rows an hourly table of it can have."""
        return sum(int((end - start) / timedelta(hours=1)) for start, end in self.ranges)


def settings_for_years(first: int, years: Iterable[int], **overrides) -> Settings:
    """Settings covering whole calendar years, counted from ``first``."""
    months = tuple(12 * (y - first) + m for y in years for m in range(1, 13))
    return Settings(year=first, months=months, **overrides)
