from dataclasses import replace

import pytest
from pyspark.sql import functions as F, types as T

from checks import compare, registry
from checks.oracle import ORACLE
from checks.registry import QUERIES, SETTINGS, Tables
from stormfare.config import Settings
from stormfare.operators.quality import GateFailure
from stormfare.plans import jobs
from stormfare.schemas import Contract
from stormfare.sinks.tables import write_table

SMALL = "/root/testdata/sf0.001"


def test_batch_run_and_rerun(spark, folder):
    t = Tables(spark, SMALL)
    settings = replace(SETTINGS, warehouse=folder, min_fact_rows=10, min_weather_rows=10)
    for _ in range(2):
        report = jobs.run(spark, settings, t.raw_trips, t.raw_weather)
        rows = {name: w.rows for name, w in report.writes.items()}
        assert rows["fact_trips"] == rows["trip_enriched"] == t.fact.count()
        assert rows["dim_weather"] == t.weather.count()
        assert rows["trip_summary_per_hour"] == t.summary.count()
        assert rows["high_value_customers"] == t.zones.count()
        assert report.rejects["rows_in"] == t.raw_trips.count()
        assert report.rejects["rows_out"] == t.clean.count()
        assert report.tests.count() == 25
        assert {r.status for r in report.gate.collect()} == {"OK"}


def test_run_stops_below_the_floor(spark, folder):
    t = Tables(spark, SMALL)
    settings = replace(SETTINGS, warehouse=folder, min_fact_rows=1_000_000, min_weather_rows=10)
    with pytest.raises(GateFailure, match="fact_trips: .* LOW"):
        jobs.run(spark, settings, t.raw_trips, t.raw_weather)
    settings = replace(settings, min_fact_rows=10)
    with pytest.raises(GateFailure, match="weather: "):
        jobs.run(spark, settings, t.raw_trips, t.raw_weather.filter("`_metadata`.weather_category <> 'Orageux'"))


def test_a_changed_file_stops_the_marts(spark, folder):
    t = Tables(spark, SMALL)
    settings = replace(SETTINGS, warehouse=folder, min_fact_rows=10, min_weather_rows=10)
    jobs.load_trips(t.raw_trips, settings)
    jobs.load_weather(t.raw_weather, settings)
    jobs.require_loads(spark, settings)
    t.fact.limit(5).write.mode("append").parquet(jobs.table_path(settings, "fact_trips") + "/pickup_year=2024/pickup_month=1")
    with pytest.raises(GateFailure, match="fact_trips: [0-9]+ files differ"):
        jobs.require_loads(spark, settings)


def test_a_write_that_fails_leaves_the_table(spark, folder):
    """The new table is whole before it takes the old one's place; nothing is left beside it."""
    import os

    contract = Contract("t", (("k", T.LongType()), ("v", T.StringType())), required=("v",))
    path = f"{folder}/t"
    good = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    for rows in (good, good.filter("k < 900")):
        write_table(rows, path, contract, partition_by=("v",), strict=True)
        assert spark.read.parquet(path).count() == rows.count()
    before = spark.read.parquet(path)
    bad = good.repartition(8).withColumn("v", F.when(F.col("k") != 777, F.lit("b")))
    with pytest.raises(Exception, match="v is null"):
        write_table(bad, path, contract, partition_by=("v",), strict=True)
    assert before.count() == spark.read.parquet(path).filter("v = 'a'").count() == 900
    assert os.listdir(folder) == ["t"]


def test_digits_that_totals_lose_are_counted(spark, folder):
    from rows import trips

    raw = trips(spark, {"fare_amount": 10.123456}, {"fare_amount": 12.34}, {"fare_amount": 99.1234})
    report, _ = jobs.load_trips(raw, Settings(months=(1,), warehouse=folder))
    assert report.broken == {"fare_amount__finer": 1}


def test_a_month_is_replaced_and_others_stay(spark, folder):
    from datetime import datetime, timedelta

    from rows import trips

    def load(year, month, count):
        days = [datetime(year, month, 3, 10, i) for i in range(count)]
        raw = trips(spark, *({"tpep_pickup_datetime": d, "tpep_dropoff_datetime": d + timedelta(minutes=9)} for d in days))
        jobs.load_trips(raw, Settings(year=year, months=(month,), warehouse=folder))

    load(2024, 1, 3)
    load(2024, 2, 2)
    load(2025, 1, 4)
    load(2024, 1, 1)
    load(2024, 2, 0)
    fact = jobs.stored(spark, Settings(warehouse=folder), "fact_trips")
    found = {(r.y, r.pickup_month): r.n for r in fact.groupBy(F.year("pickup_date").alias("y"), "pickup_month")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert found == {(2024, 1): 1, (2025, 1): 4}


def test_enriched_is_read_by_date(spark, folder, capsys):
    t = Tables(spark, SMALL)
    settings = replace(SETTINGS, warehouse=folder, min_fact_rows=10, min_weather_rows=10)
    jobs.run(spark, settings, t.raw_trips, t.raw_weather)
    enriched = jobs.stored(spark, settings, "trip_enriched").filter("pickup_date = DATE'2024-01-05'")
    enriched.explain("formatted")
    assert "PartitionFilters: [isnotnull(pickup_date" in capsys.readouterr().out


def test_every_query_has_its_statement():
    assert set(ORACLE) == set(QUERIES)


@pytest.fixture(scope="module")
def database():
    return compare.database(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_statement(spark, database, name):
    assert compare.differences(spark, database, name, SMALL) is None


def test_whole_feed_is_validated_and_reloaded(spark):
    """Every day of the feed is counted, not its first days alone."""
    trips = Tables(spark, SMALL).raw_trips
    days = {r.day: r.n for r in trips.groupBy(F.dayofmonth("tpep_pickup_datetime").alias("day")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    checked = QUERIES["schema_validation_all"](spark, SMALL).collect()
    assert {r.folder: r.rows for r in checked if r.month == "2024-01"} == {f"day={d}": n for d, n in days.items()}
    assert max(days) > 16
    states = {r.state: r.folders for r in QUERIES["manifest_comparison_all"](spark, SMALL).collect()}
    assert sum(states.values()) == len(days) and set(states) == {"same", "changed", "new", "missing"}
    assert QUERIES["ingest_report_all"](spark, SMALL).first().rows == sum(days.values())


def test_a_day_of_weather_is_many_files(spark, monkeypatch):
    monkeypatch.setattr(registry, "PRETTY_ROWS", 2)
    path = registry._pretty_weather(Tables(spark, SMALL)).weather_path
    days = spark.read.option("recursiveFileLookup", "true").text(f"{path}/year=2024/month=1/day=2", wholetext=True)
    assert days.count() > 1
    assert compare.differences(spark, compare.database(SMALL), "weather_json_scan", SMALL) is None
