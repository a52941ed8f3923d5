"""Catalog tables and views, bucketed joins, summaries, fixed-size samples."""

import uuid
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from checks import registry
from checks.registry import SETTINGS, Tables
from stormfare.operators import sketches
from stormfare.plans import jobs, marts, questions, staging
from stormfare.sources import catalog

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SMALL)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_declared_tables_and_the_view_are_read_by_another_session(spark, folder, tables):
    settings = replace(SETTINGS, warehouse=folder, min_fact_rows=10, min_weather_rows=10)
    jobs.run(spark, settings, tables.raw_trips, tables.raw_weather)
    database = f"stored_{uuid.uuid4().hex}"
    for _ in range(2):  # declaring again changes nothing
        jobs.declare(spark, settings, database)
    other = spark.newSession()
    for name in jobs.TABLES:
        names = jobs.CONTRACTS[name].names
        assert rows(other.table(f"{database}.{name}").select(*names)) == rows(jobs.stored(spark, settings, name))
    view = other.table(f"{database}.stg_weather")
    staged = staging.stage_weather(jobs.stored(spark, settings, "dim_weather"))
    assert view.columns == staged.columns and rows(view) == rows(staged)
    # The view is computed when it is read: a month loaded without rows is gone from it.
    assert view.filter("month(obs_date) = 1").count() > 0
    jobs.load_weather(tables.raw_weather.limit(0), replace(settings, months=(1,)))
    jobs.declare(spark, settings, database)
    assert spark.newSession().table(f"{database}.stg_weather").filter("month(obs_date) = 1").count() == 0


def test_widths_are_held_by_the_table(spark, folder, tables):
    database = f"widths_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/db'")
    contract = jobs.CONTRACTS["fact_trips"]
    catalog.create_table(spark, f"{database}.fact", contract, f"{folder}/fact")
    fact = contract.conform(tables.fact)
    fact.write.insertInto(f"{database}.fact", overwrite=True)
    assert spark.table(f"{database}.fact").count() == fact.count()
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH"):
        fact.withColumn("distance_bucket", F.lit("more than ten letters")).write.insertInto(f"{database}.fact")
    assert "VARCHAR(10)" in catalog.columns_of(contract) and spark.table(f"{database}.fact").count() == fact.count()


def test_equal_buckets_join_without_a_shuffle(spark, capsys, tables):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = registry.bucketed_enriched(tables)
        capsys.readouterr()
        joined.explain()
        text = capsys.readouterr().out
        assert "Exchange" not in text and "SortMergeJoin" in text
        assert rows(joined) == rows(marts.enrich_trips(tables.fact, tables.staged_weather, SETTINGS))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_merged_summaries_stay_within_their_errors(spark):
    """Many distinct values, one zone with a third of the rows, summaries of many hours merged twice."""
    trips = spark.range(300_000).select(
        F.to_date(F.lit("2024-01-01")).alias("pickup_date"), (F.col("id") % 24).cast("int").alias("pickup_hour"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).cast("int").alias("pickup_location_id"),
        (F.col("id") % 70_001 / 100).alias("total_amount"), (F.xxhash64("id") % 5_000 / 100).alias("minutes"))
    summaries = sketches.summarize(trips, "total_amount", "minutes").cache()
    for keys in (["pickup_hour"], ["pickup_location_id"], []):
        exact = trips.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("total_amount").alias("d"),
            *(F.percentile("minutes", 0.9 + e).alias(name) for name, e in (
                ("low", -sketches.RANK_ERROR), ("high", sketches.RANK_ERROR))))
        found = {tuple(r[k] for k in keys): r for r in sketches.merged(summaries, keys, 0.9).collect()}
        for r in exact.collect():
            own = found[tuple(r[k] for k in keys)]
            assert own.rows == r.n and abs(own.distinct_values - r.d) <= max(1, sketches.DISTINCT_ERROR * r.d)
            assert r.low <= own.quantile <= r.high
    assert sketches.merged(summaries.limit(0), ["pickup_hour"]).count() == 0


def test_a_sample_has_just_its_size(tables):
    short = tables.fact.filter(F.col("trip_duration_minutes").between(1, 60)).count()
    some = rows(questions.duration_sample_of(tables.fact, 20))
    assert len(some) == 20 and some == rows(questions.duration_sample_of(tables.fact.repartition(5), 20))
    assert questions.duration_sample_of(tables.fact, 10 * short).count() == short
