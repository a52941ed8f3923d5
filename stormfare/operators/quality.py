"""Declarative data tests. Every test reports; none stops the others."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as fv

NOT_NULL, UNIQUE, ACCEPTED, RELATION = (
    "not_null", "unique", "accepted_values", "relationships",
)


@dataclass(frozen=True)
class Check:
    """One test of one column. ``values`` lists accepted values; ``parent`` names
    the table and column a relationship points to."""

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    parent: tuple[str, str] = ("", "")

    @property
    def row_condition(self) -> Column | None:
        """Condition of a failing row, for tests that look at single rows."""
        col = F.col(self.column)
        if self.kind == NOT_NULL:
            return col.isNull()
        if self.kind == ACCEPTED:
            return col.isNotNull() & ~col.isin(*self.values)
        return None


def _label(result: DataFrame, check: Check) -> DataFrame:
    return result.select(
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("test"),
        F.col("failures"),
    )


def _with_key_checks(table: DataFrame, unique: Check, checks: list[Check]) -> DataFrame:
    """A table's uniqueness test and its single-row tests in one pass: sums per key, then over the keys."""
    per_key = table.groupBy(F.col(unique.column).alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"),
        *(F.count_if(c.row_condition).alias(f"_{i}") for i, c in enumerate(checks)),
    )
    counted = per_key.agg(
        F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias("_unique"),
        *(F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(checks))),
    )
    return counted.select(F.inline(_results([(unique, "_unique"), *((c, f"_{i}") for i, c in enumerate(checks))])))


def _results(counted: list[tuple[Check, str]]) -> Column:
    return F.array(*(
        F.struct(
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            F.lit(c.kind).alias("test"),
            F.col(name).alias("failures"),
        )
        for c, name in counted
    ))


def _row_checks(table: DataFrame, checks: list[Check]) -> DataFrame:
    """All single-row tests of a table in one aggregation, one result row each."""
    counted = table.agg(
        *(F.count_if(c.row_condition).alias(f"_{i}") for i, c in enumerate(checks))
    )
    return counted.select(F.inline(_results([(c, f"_{i}") for i, c in enumerate(checks)])))


def _unique(table: DataFrame, check: Check) -> DataFrame:
    """Failures are the values found more than once."""
    repeated = (
        table.filter(F.col(check.column).isNotNull())
        .groupBy(check.column)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )
    return _label(repeated.agg(F.count(F.lit(1)).alias("failures")), check)


def _relation(child: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    """Failures are the child rows whose value the parent lacks."""
    keys = parent.select(F.col(check.parent[1]).alias("_key")).distinct()
    # Counting per value first keeps a frequent value from filling one join task.
    values = (
        child.filter(F.col(check.column).isNotNull())
        .groupBy(check.column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    orphans = values.join(keys, F.col(check.column) == F.col("_key"), "left_anti")
    return _label(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures")), check)


def run_suite(tables: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Result row of every test: table, column, test, failures, PASS or FAIL."""
    results = []
    for name, table in tables.items():
        mine = [c for c in checks if c.table == name]
        if not mine:
            continue
        by_row = [c for c in mine if c.row_condition is not None]
        unique = [c for c in mine if c.kind == UNIQUE]
        if unique and by_row:
            results.append(_with_key_checks(table, unique[0], by_row))
            results += [_unique(table, c) for c in unique[1:]]
        elif by_row:
            results.append(_row_checks(table, by_row))
        else:
            results += [_unique(table, c) for c in unique]
        for check in mine:
            if check.kind == RELATION:
                results.append(_relation(table, tables[check.parent[0]], check))
    found = reduce(DataFrame.union, results)
    return found.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))


def row_tests(table: str, checks: list[Check]) -> dict[str, Column]:
    """Conditions of failing rows of a table's single-row tests, by the test's name, for the write to count."""
    return {f"{c.column} {c.kind}": c.row_condition
            for c in checks if c.table == table and c.row_condition is not None}


def suite_of_writes(spark: SparkSession, tables: Mapping[str, DataFrame], checks: list[Check],
                    tested: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """The results of :func:`run_suite`, single-row tests as the writes counted them: only the others read a table."""
    counted, others = [], []
    for check in checks:
        failures = tested.get(check.table, {}).get(f"{check.column} {check.kind}")
        if failures is None:
            others.append(check)
        else:
            counted.append((check.table, check.column, check.kind, failures))
    given = spark.createDataFrame(counted, "table_name string, column_name string, test string, failures long")
    found = given.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))
    return found.unionByName(run_suite(tables, others)) if others else found


# --- Fixed values: the tests of the curated tables -----------------------------
ENRICHED_CATEGORIES = (*fv.FEED_WEATHER_CATEGORIES, fv.UNKNOWN_WEATHER)
DIMENSION_CATEGORIES = (*fv.FEED_WEATHER_CATEGORIES, fv.OTHER_WEATHER)

CURATED_CHECKS = [
    Check("trip_enriched", "trip_id", UNIQUE),
    Check("trip_enriched", "trip_id", NOT_NULL),
    Check("trip_enriched", "pickup_datetime", NOT_NULL),
    Check("trip_enriched", "weather_category", NOT_NULL),
    Check("trip_enriched", "weather_category", ACCEPTED, ENRICHED_CATEGORIES),
    Check("trip_enriched", "tip_percentage", NOT_NULL),
    Check("trip_enriched", "distance_bucket", NOT_NULL),
    Check("trip_enriched", "distance_bucket", ACCEPTED, fv.DISTANCE_BUCKET_LABELS),
    Check("trip_summary_per_hour", "pickup_hour", NOT_NULL),
    Check("trip_summary_per_hour", "trip_count", NOT_NULL),
    Check("trip_summary_per_hour", "avg_tip_pct", NOT_NULL),
    Check("high_value_customers", "pickup_location_id", UNIQUE),
    Check("high_value_customers", "pickup_location_id", NOT_NULL),
    Check("high_value_customers", "total_spent", NOT_NULL),
    Check("high_value_customers", "trip_count", NOT_NULL),
    Check("fact_trips", "pickup_datetime", NOT_NULL),
    Check("fact_trips", "trip_duration_minutes", NOT_NULL),
    Check("fact_trips", "distance_bucket", NOT_NULL),
    Check("fact_trips", "distance_bucket", ACCEPTED, fv.DISTANCE_BUCKET_LABELS),
    Check("fact_trips", "payment_type", NOT_NULL),
    Check("dim_weather", "observation_ts", NOT_NULL),
    Check("dim_weather", "observation_hour", NOT_NULL),
    Check("dim_weather", "observation_hour", UNIQUE),
    Check("dim_weather", "weather_category", NOT_NULL),
    Check("dim_weather", "weather_category", ACCEPTED, DIMENSION_CATEGORIES),
]


# --- Gates ----------------------------------------------------------------------


def row_count_gate(tables: Mapping[str, DataFrame], floors: Mapping[str, int]) -> DataFrame:
    """Rows of each table against its floor: EMPTY, LOW or OK."""
    gates = [
        tables[name].agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table_name"), "rows", F.lit(floor).cast("long").alias("minimum")
        )
        for name, floor in floors.items()
    ]
    state = (
        F.when(F.col("rows") == 0, "EMPTY")
        .when(F.col("rows") < F.col("minimum"), "LOW")
        .otherwise("OK")
    )
    return reduce(DataFrame.union, gates).withColumn("status", state)


def weather_gate(weather: DataFrame, minimum: int = fv.MIN_WEATHER_ROWS) -> DataFrame:
    """Row floor, presence of the feed's categories and nulls, in one scan."""
    critical = ["observation_ts", "observation_hour", "temp_celsius", "weather_category"]
    present = reduce(
        lambda a, b: a + b,
        (
            F.max(F.when(F.col("weather_category") == label, 1).otherwise(0))
            for label in fv.FEED_WEATHER_CATEGORIES
        ),
    )
    has_null = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in critical))
    seen = weather.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(present, F.lit(0)).alias("categories_present"),
        F.count_if(has_null).alias("rows_with_null"),
    )
    passed = (
        (F.col("rows") >= minimum)
        & (F.col("categories_present") == len(fv.FEED_WEATHER_CATEGORIES))
        & (F.col("rows_with_null") == 0)
    )
    return seen.withColumn("status", F.when(passed, "PASS").otherwise("FAIL"))


class GateFailure(RuntimeError):
    """A table did not reach its row floor."""


def require_weather(gate: DataFrame) -> None:
    """Raise when a weather gate did not pass."""
    row = gate.first()
    if row.status != "PASS":
        raise GateFailure(
            f"weather: {row.rows} rows, {row.categories_present} categories, {row.rows_with_null} rows with null")


def require_unique(table: DataFrame, name: str, column: str) -> None:
    """Raise when a value stands in more than one row: a join on it would repeat the other side."""
    failures = _unique(table, Check(name, column, UNIQUE)).first().failures
    if failures:
        raise GateFailure(f"{name}: {failures} values of {column} stand more than once")


def require(gate: DataFrame) -> None:
    """Raise when any table of a row-count gate is not OK."""
    bad = gate.filter(F.col("status") != "OK").collect()  # one row per gated table
    if bad:
        raise GateFailure("; ".join(f"{r.table_name}: {r.rows} rows, {r.status}" for r in bad))
