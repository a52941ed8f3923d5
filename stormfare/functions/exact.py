"""Sums, averages and rounding that do not depend on the order of the rows.

Adding doubles gives slightly different totals for every partitioning, so a
retried task could change a published figure. Values are therefore added as
whole numbers of ten-thousandths. Stored amounts have at most four decimals, so
nothing is lost; the load counts the rows for which that is not so (``finer``).
A column with finer values is added with as many ``decimals`` as it has. A 64-bit
total holds 9e14 at four decimals, 9e10 at eight, before it fails with an error.
Decimals would do the same about ten times slower.

Rounding is half-up, as a warehouse's ``numeric`` rounds: first to millionths,
which removes the noise of the double, then to the wanted places.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNIT_DECIMALS = 4
UNIT = 10**UNIT_DECIMALS
_FINEST = 6  # decimals


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def units(value: Column | str, decimals: int = UNIT_DECIMALS) -> Column:
    """The value as a whole number of its last decimal's unit, ten-thousandths if nothing else is said."""
    return F.rint(_col(value) * float(10**decimals)).cast("long")


def finer(value: Column | str, decimals: int = UNIT_DECIMALS) -> Column:
    """Whether a value has digits past the last that totals keep."""
    scaled = _col(value) * float(10**decimals)
    # A double that stands for four decimals is off by some billionths at most.
    return F.abs(scaled - F.rint(scaled)) > F.lit(1e-6) * F.greatest(F.abs(scaled) * 1e-6, F.lit(1.0))


def half_up(value: Column | str, places: int) -> Column:
    """Round half away from zero to ``places`` and return a double."""
    millionths = F.rint(_col(value) * float(10**_FINEST)).cast("long")
    return F.round(millionths, places - _FINEST) / float(10**_FINEST)


def unit_sum(value: Column | str, decimals: int = UNIT_DECIMALS) -> Column:
    """Exact total in units of the last decimal, for comparisons with thresholds."""
    return F.sum(units(value, decimals))


def _total(unit_total: Column, places: int, decimals: int = UNIT_DECIMALS) -> Column:
    return F.round(unit_total, min(places - decimals, 0)) / float(10**decimals)


def _mean(unit_total: Column, count: Column, places: int, decimals: int = UNIT_DECIMALS) -> Column:
    return half_up(F.try_divide(unit_total.cast("double"), count * float(10**decimals)), places)


def total(value: Column | str, places: int, decimals: int = UNIT_DECIMALS) -> Column:
    return _total(unit_sum(value, decimals), places, decimals)


def mean(value: Column | str, places: int, decimals: int = UNIT_DECIMALS) -> Column:
    """Average of the non-null values, rounded half-up."""
    return _mean(unit_sum(value, decimals), F.count(_col(value)), places, decimals)


def percent(part: Column, whole: Column, places: int) -> Column:
    """``part`` as a percentage of ``whole``; NULL for an empty whole."""
    return half_up(F.try_divide(part * 100.0, whole.cast("double")), places)


# --- Two-step aggregation ----------------------------------------------------
# A median needs the values of a group in one place. Grouping by (key, value)
# first leaves one row per distinct value, spread over all tasks, so even a key
# holding a third of the table reaches the second step as a short list. The
# helpers below carry ordinary averages and totals through both steps.

WEIGHT = "_rows"


def weight() -> Column:
    """First step: how many rows share the value."""
    return F.count(F.lit(1)).alias(WEIGHT)


def partial(*names: str, decimals: int = UNIT_DECIMALS) -> list[Column]:
    """First step: exact total and non-null count of each column."""
    return [
        agg
        for name in names
        for agg in (unit_sum(name, decimals).alias(f"_sum_{name}"), F.count(name).alias(f"_n_{name}"))
    ]


def merged_count() -> Column:
    return F.sum(WEIGHT)


def merged_mean(name: str, places: int, decimals: int = UNIT_DECIMALS) -> Column:
    """Second step: average of a column carried by :func:`partial` with as many decimals."""
    return _mean(F.sum(f"_sum_{name}"), F.sum(f"_n_{name}"), places, decimals)


def merged_total(name: str, places: int, decimals: int = UNIT_DECIMALS) -> Column:
    return _total(F.sum(f"_sum_{name}"), places, decimals)


def _weighted_count(name: str) -> Column:
    return F.sum(F.when(F.col(name).isNotNull(), F.col(WEIGHT)).otherwise(0))


def weighted_mean(name: str, places: int) -> Column:
    """Second step: average of the value grouped by in the first step."""
    return _mean(F.sum(units(name) * F.col(WEIGHT)), _weighted_count(name), places)


def weighted_quantile(name: str, q: float, places: int) -> Column:
    """Second step: interpolated quantile over values and their frequencies."""
    return half_up(F.percentile(name, q, F.col(WEIGHT)), places)


def weighted_stddev(name: str, places: int) -> Column:
    """Second step: sample standard deviation; NULL for fewer than two rows.

    Squares outgrow 64 bits, so they are added as decimals: there are few rows
    left to add.
    """
    n = _weighted_count(name).cast("double")
    value = units(name).cast("decimal(18,0)")
    sum_x = F.sum(value * F.col(WEIGHT)).cast("double")
    sum_xx = F.sum((value * value).cast("decimal(28,0)") * F.col(WEIGHT)).cast("double")
    spread = F.greatest(sum_xx - F.try_divide(sum_x * sum_x, n), F.lit(0.0))
    return half_up(F.sqrt(F.try_divide(spread, F.when(n > 1, n - 1))) / float(UNIT), places)


# --- Correlation ---------------------------------------------------------------


def pearson(x: str, y: str, places: int) -> Column:
    """Pearson correlation; NULL where either side does not vary.

    Built from covariance and deviations because ``corr`` divides by zero for a
    constant column.
    """
    paired_x = F.when(F.col(y).isNotNull(), F.col(x))
    paired_y = F.when(F.col(x).isNotNull(), F.col(y))
    spread = F.stddev_pop(paired_x) * F.stddev_pop(paired_y)
    return half_up(F.try_divide(F.covar_pop(x, y), spread), places)
