"""The batch run: load both feeds, build the marts, verify."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..config import Settings
from ..functions.exact import finer
from ..functions.time import in_period
from ..operators import quality, trips as trip_ops, weather as weather_ops
from ..schemas import DIM_WEATHER, FACT_TRIPS, HIGH_VALUE_ZONES, TRIP_ENRICHED, TRIP_SUMMARY
from ..session import delete
from ..sinks.tables import WriteReport, write_table
from ..sources import catalog, manifest
from ..sources.files import listing
from . import marts, staging

CONTRACTS = {
    c.name: c for c in (FACT_TRIPS, DIM_WEATHER, TRIP_ENRICHED, TRIP_SUMMARY, HIGH_VALUE_ZONES)
}
#: Trip columns that totals and averages are made of.
SUMMED = ("trip_duration_minutes", "trip_distance", "fare_amount", "tip_amount", "total_amount", "tip_percentage")
TABLES = ("fact_trips", "dim_weather", "trip_enriched", "trip_summary_per_hour",
          "high_value_customers")


@dataclass(frozen=True)
class RunReport:
    """What the run wrote and rejected, and the tests of its tables."""

    writes: dict[str, WriteReport]
    rejects: dict[str, int]
    tests: DataFrame
    gate: DataFrame


def table_path(settings: Settings, name: str) -> str:
    return f"{settings.warehouse.rstrip('/')}/{name}"


def stored(spark: SparkSession, settings: Settings, name: str) -> DataFrame:
    """A table's own columns; folder columns its contract does not know are left out."""
    table = spark.read.parquet(table_path(settings, name))
    names = CONTRACTS[name].names if name in CONTRACTS else table.columns
    return table.select(*names)


def manifest_path(settings: Settings, name: str) -> str:
    return table_path(settings, f"{name}_manifest")


def _store_manifest(spark: SparkSession, settings: Settings, name: str) -> None:
    """Names and sizes of a table's files as the load left them."""
    path = table_path(settings, name)
    root = path.split(":")[-1].lstrip("/") + "/"
    files = listing(spark, path).select(F.substring_index("path", root, -1).alias("file"), "length")
    files.coalesce(1).write.mode("overwrite").parquet(manifest_path(settings, name))


def changed_files(spark: SparkSession, settings: Settings, name: str) -> DataFrame:
    """Files of a table that are not as the load left them."""
    path = table_path(settings, name)
    kept = spark.read.parquet(manifest_path(settings, name))
    return manifest.size_differences(kept, listing(spark, path), path)


def _replace_period(df: DataFrame, settings: Settings, contract, names: tuple[str, str], date: str,
                    gather: bool, counted: tuple = ()) -> WriteReport:
    """Replace the months of the period, whatever others the table has.

    Months that have no rows any more lose their folder.
    """
    year, month = names
    path = table_path(settings, contract.name)
    report = write_table(
        df, path, contract, partition_by=names, gather=gather, only_these_partitions=True,
        derived={year: F.year(date), month: F.month(date)}, counted=counted,
        tested=quality.row_tests(contract.name, quality.CURATED_CHECKS),
    )
    spark = df.sparkSession
    for y, m in settings.month_parts:
        if f"{year}={y}/{month}={m}" not in report.partitions:
            delete(spark, f"{path}/{year}={y}/{month}={m}")
    _store_manifest(spark, settings, contract.name)
    return report


def load_trips(raw: DataFrame, settings: Settings) -> tuple[WriteReport, dict[str, int]]:
    """Raw trips of the period to the fact table; the write counts the rejects.

    One pass without a shuffle: raw files hold a month each, so a task writes to
    one month's folder, or to few. Other months stay as they are.
    """
    metrics = Observation()
    fact = trip_ops.fact_trips(trip_ops.clean_observed(raw, settings, metrics), settings)
    report = _replace_period(
        fact, settings, FACT_TRIPS, ("pickup_year", "pickup_month"), "pickup_date", gather=False,
        counted=tuple(F.count_if(finer(c)).alias(f"{c}__finer") for c in SUMMED))
    return report, dict(metrics.get)


def load_weather(raw: DataFrame, settings: Settings) -> WriteReport:
    """Hourly weather of the period to the dimension; other months stay as they are."""
    hours = weather_ops.dim_weather(raw).filter(in_period("observation_hour", settings.ranges))
    return _replace_period(hours, settings, DIM_WEATHER, ("obs_year", "obs_month"), "obs_date", gather=True)


def build_marts(spark: SparkSession, settings: Settings) -> dict[str, WriteReport]:
    """Enriched trips first; the two aggregates read the written table.

    Numbering moves whole rows, so columns no mart has are left out before it.
    """
    fact = stored(spark, settings, "fact_trips")
    used = [c for c in fact.columns if c in TRIP_ENRICHED.names]
    trips = staging.stage_trips(fact.select(*used))
    hours = stored(spark, settings, "dim_weather")
    quality.require_unique(hours, "dim_weather", "observation_hour")
    weather = staging.stage_weather(hours)
    reports = {
        "trip_enriched": write_table(
            marts.enrich_trips(trips, weather, settings),
            table_path(settings, "trip_enriched"),
            TRIP_ENRICHED,
            partition_by=("pickup_date",), gather=True, sort_by=("pickup_datetime",),
            tested=quality.row_tests("trip_enriched", quality.CURATED_CHECKS),
        )
    }
    enriched = stored(spark, settings, "trip_enriched")
    for name, mart, contract in (
        ("trip_summary_per_hour", marts.trip_summary, TRIP_SUMMARY),
        ("high_value_customers", marts.high_value_zones, HIGH_VALUE_ZONES),
    ):
        reports[name] = write_table(
            mart(enriched), table_path(settings, name), contract,
            tested=quality.row_tests(name, quality.CURATED_CHECKS))
    return reports


#: Columns that name a table's folders; those a contract lacks come with their type.
FOLDERS = {
    "fact_trips": {"pickup_year": "int", "pickup_month": "int"},
    "dim_weather": {"obs_year": "int", "obs_month": "int"},
    "trip_enriched": {"pickup_date": "date"},
}


def declare(spark: SparkSession, settings: Settings, database: str, names: tuple[str, ...] = TABLES) -> None:
    """Declare stored tables in a database of the catalog, and the staged weather as a view over it."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{settings.warehouse.rstrip('/')}/{database}'")
    for name in names:
        catalog.create_table(
            spark, f"{database}.{name}", CONTRACTS[name], table_path(settings, name), FOLDERS.get(name))
    if "dim_weather" in names:
        catalog.create_view(spark, f"{database}.stg_weather", staging.stg_weather_sql(f"{database}.dim_weather"))


def floors_gate(spark: SparkSession, settings: Settings) -> DataFrame:
    floors = {"fact_trips": settings.min_fact_rows, "dim_weather": settings.min_weather_rows}
    return quality.row_count_gate({name: stored(spark, settings, name) for name in floors}, floors)


def verify(spark: SparkSession, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Results of the data tests, and the row-count gate."""
    tables = {name: stored(spark, settings, name) for name in TABLES}
    return quality.run_suite(tables, quality.CURATED_CHECKS), floors_gate(spark, settings)


def verify_writes(spark: SparkSession, settings: Settings, writes: dict[str, WriteReport]) -> tuple[DataFrame, DataFrame]:
    """As :func:`verify`, from what the writes of a run counted; only the tests of uniqueness read a table.

    Months of the fact table and the dimension that the run did not load were
    tested by the run that did.
    """
    tables = {name: stored(spark, settings, name) for name in TABLES}
    tested = {name: report.tested for name, report in writes.items()}
    return quality.suite_of_writes(spark, tables, quality.CURATED_CHECKS, tested), floors_gate(spark, settings)


def require_loads(spark: SparkSession, settings: Settings) -> None:
    """Raise unless both loads reach their floors and their files are as they were written."""
    quality.require(floors_gate(spark, settings))
    weather = stored(spark, settings, "dim_weather")
    quality.require_weather(quality.weather_gate(weather, settings.min_weather_rows))
    for name in ("fact_trips", "dim_weather"):
        if changed := changed_files(spark, settings, name).count():
            raise quality.GateFailure(f"{name}: {changed} files differ from the manifest")


def run(
    spark: SparkSession, settings: Settings, raw_trips: DataFrame, raw_weather: DataFrame
) -> RunReport:
    """Everything from the raw feeds to verified marts, below ``settings.warehouse``.

    Raises :class:`quality.GateFailure` when a table is below its floor, the
    weather gate fails, or a file is not as its load left it.
    """
    trips, rejects = load_trips(raw_trips, settings)
    writes = {"fact_trips": trips, "dim_weather": load_weather(raw_weather, settings)}
    require_loads(spark, settings)
    writes.update(build_marts(spark, settings))
    tests, gate = verify_writes(spark, settings, writes)
    return RunReport(writes, rejects, tests, gate)
