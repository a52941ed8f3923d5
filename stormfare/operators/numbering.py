"""A gap-free number over the whole table, without sorting it in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, Window, functions as F

#: About as many rows go to one range.
HOT_ROWS = 1_000_000
#: Rows sampled for the bounds of the ranges, and ranges, at most and at least.
SAMPLE_ROWS = 8_192
MOST_RANGES, LEAST_RANGES = 512, 32


def minute_cell(ts: str) -> Column:
    """Minutes since 1970 by the wall clock: grows with the time, whatever the session zone."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01"))
    return days.cast("long") * 1440 + F.hour(ts) * 60 + F.minute(ts)


def _sampled_bounds(keys: DataFrame) -> list[tuple]:
    """First keys of all ranges but the lowest, NULLs last; one narrow pass, the same in every run.

    A bound is cut after the first column that sets it apart from the one before,
    so a bound of one column is enough unless a value fills several ranges.
    """
    seen = Observation()
    counted = keys.observe(seen, F.count(F.lit(1)).alias("rows"))
    sample = counted.orderBy(F.xxhash64(*keys.columns, F.lit(1)), *keys.columns).limit(SAMPLE_ROWS).collect()
    wanted = min(MOST_RANGES, max(LEAST_RANGES, -(-seen.get["rows"] // HOT_ROWS)))
    ranked = sorted(set(sample), key=lambda row: tuple((v is None, v) for v in row))
    bounds, last = [], Row()
    for row in ranked[::max(1, len(sample) // wanted)]:
        shared = next((i for i, (v, w) in enumerate(zip(row, last)) if v != w), 0)
        bounds.append(tuple(row[:shared + 1]))
        last = row
    return bounds[1:]


def _reached(own: list[Column], bound: tuple) -> Column:
    """Whether a row's keys are at or behind a bound, NULLs last."""
    def behind(column: Column, value) -> Column:
        return F.lit(False) if value is None else F.coalesce(column > F.lit(value), F.lit(True))

    def level(column: Column, value) -> Column:
        return column.isNull() if value is None else column.eqNullSafe(F.lit(value))

    pairs = list(zip(own, bound))[::-1]
    return reduce(lambda rest, p: behind(*p) | (level(*p) & rest), pairs, F.lit(True))


def _tree(own: list[Column], bounds: list[tuple], first: int = 0) -> Column:
    """How many bounds a row has reached, as nested comparisons."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(_reached(own, bounds[middle]), _tree(own, bounds[middle + 1:], first + middle + 1)).otherwise(
        _tree(own, bounds[:middle], first))


def _range_of(own: list[Column], bounds: list[tuple]) -> Column:
    """How many bounds a row has reached.

    Bounds of one column are searched by halving their list, which stays out of
    the generated code of the row; only values that fill several ranges need more.
    """
    single = [b[0] for b in bounds if len(b) == 1 and b[0] is not None]
    listed = F.array(*map(F.lit, single))
    halves = F.array(*(F.lit(1 << i) for i in reversed(range(len(single).bit_length()))))

    def halved(at: Column, half: Column) -> Column:
        ahead = (at + half <= len(single)) & (F.get(listed, at + half - 1) <= own[0])
        return F.when(ahead, at + half).otherwise(at)

    found = F.aggregate(halves, F.lit(0), halved) if single else F.lit(0)
    if (None,) in bounds:
        found = F.when(own[0].isNull(), len(single) + 1).otherwise(found)
    else:
        found = F.when(own[0].isNull(), len(single)).otherwise(found)
    return found + _tree(own, [b for b in bounds if len(b) > 1])


def with_row_number(df: DataFrame, order: list[str], name: str, cell: Column | None = None) -> DataFrame:
    """Number rows 1..n by ``order``, NULLs last; rows equal in ``order`` by a hash of the row.

    The table is cut into ranges of the whole order, by bounds from a sample of at
    most ``SAMPLE_ROWS`` rows: a minute or a key with a third of the rows fills as
    many ranges as its rows need; rows that agree in all of ``order`` share one.
    Bounds only deal out the work, any would give the same numbers. The sample and
    the rows per range, which give each range its first number, read the columns
    of ``order`` alone; then the rows are shuffled once, by range. Nothing is
    written. ``cell``, which must not fall where the first column of ``order``
    grows, is a first key for bounds where that column itself compares dearly.
    """
    leading = [] if cell is None else [cell.alias("_cell")]
    own = [*leading, *(F.col(c) for c in order)]
    place = _range_of(own, _sampled_bounds(df.select(*own))).alias("_range")
    counts = df.select(place).groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row for each range.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_range").orderBy(
        *(F.asc_nulls_last(c) for c in order), F.xxhash64(*df.columns))
    numbered = df.select("*", place).withColumn("_place", F.row_number().over(within))
    return numbered.join(F.broadcast(bases), "_range").select(
        (F.col("_before") + F.col("_place")).alias(name), *df.columns)
