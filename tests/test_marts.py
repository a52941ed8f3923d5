import os
import statistics
from datetime import datetime, timedelta
from itertools import product

import pytest
from pyspark.sql import Window, functions as F

from checks.registry import SETTINGS, Tables
from rows import observation, trips, weather
from stormfare.config import Settings
from stormfare.operators import joins, numbering, trips as trip_ops, weather as weather_ops
from stormfare.operators.numbering import with_row_number
from stormfare.plans import marts, questions, staging
from stormfare.schemas import TRIP_ENRICHED
from stormfare.session import shared_dir

SMALL = "/root/testdata/sf0.001"
S = Settings()


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SMALL)


def fact(spark, *changes):
    return trip_ops.fact_trips(trips(spark, *changes), S)


def dimension(spark, *documents):
    return staging.stage_weather(weather_ops.dim_weather(weather(spark, *documents)))


def test_trip_without_weather_is_kept(spark):
    noon = datetime(2024, 1, 8, 12, 10)
    f = fact(spark, {}, {"tpep_pickup_datetime": noon,
                         "tpep_dropoff_datetime": noon + timedelta(minutes=5)})
    w = dimension(spark, observation("2024-01-07T14:00:00", category="Clair"))
    rows = marts.enrich_trips(f, w, S).orderBy("pickup_datetime").collect()
    assert [(r.weather_category, r.temp_celsius) for r in rows] == [("Clair", 5.0), ("Inconnu", None)]
    assert rows[0].wind_speed_kmh == 15.1
    assert joins.join_hourly(f, w, S, "inner").count() == 1


def test_join_kind_follows_the_size(spark, capsys, tables):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        result = marts.enrich_trips(tables.fact, tables.staged_weather, S)
        result.explain()
        assert "BroadcastHashJoin" not in capsys.readouterr().out
        assert result.count() == tables.fact.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_enriched_contract_and_conservation(tables):
    numbered = marts.enrich_trips(tables.staged_trips, tables.staged_weather, SETTINGS)
    assert numbered.columns == TRIP_ENRICHED.names and len(numbered.columns) == 27
    assert numbered.count() == tables.fact.count()
    counted = tables.summary.agg(F.sum("trip_count")).first()[0]
    assert counted == marts.known_weather(tables.enriched).count()


def test_row_number_equals_the_global_one(spark, tables):
    order = staging.TRIP_ORDER
    numbered = with_row_number(tables.fact.drop("ingested_at"), order, "trip_id")
    expected = numbered.withColumn(
        "n", F.row_number().over(Window.orderBy(*(F.asc_nulls_last(c) for c in order)))
    )
    assert expected.filter("n <> trip_id").count() == 0


@pytest.mark.parametrize("limit", [numbering.HOT_ROWS, 100])
def test_row_number_cuts_up_hot_cells(spark, monkeypatch, limit):
    """A third of the rows are copies of one row, and one cell holds half of all keys."""
    monkeypatch.setattr(numbering, "HOT_ROWS", limit)
    copies = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v")
    )
    cell = F.floor(F.col("k") / 15_000)
    numbered = with_row_number(copies, ["k"], "n", cell).cache()
    ends = numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(ends) == (1, 30_000, 30_000)
    hot = numbered.filter("k = 7").agg(F.min("n"), F.max("n"), F.count("n")).first()
    assert hot[1] - hot[0] + 1 == hot[2]  # copies of a key are numbered without gaps
    order = numbered.withColumn("r", F.rank().over(Window.orderBy("k")))
    assert order.groupBy("k").agg((F.min("n") == F.min("r")).alias("ok")).filter("NOT ok").count() == 0


def test_a_hot_minute_fills_many_ranges(spark, monkeypatch):
    """A minute, and one second of it, hold a third of the rows; some times are missing."""
    monkeypatch.setattr(numbering, "SAMPLE_ROWS", 2_000)
    hot = F.col("id") % 3 == 0
    second = F.when(hot, F.when(F.col("id") % 2 == 0, 30).otherwise(F.col("id") % 60)).otherwise(F.col("id") * 7)
    rows = spark.range(60_000, numPartitions=5).select(
        F.when(F.col("id") % 101 != 0, F.timestamp_seconds(second).cast("timestamp_ntz")).alias("ts"),
        F.when(F.col("id") % 97 != 0, F.col("id") % 263).alias("zone"), "id")
    order = ["ts", "zone", "id"]
    bounds = numbering._sampled_bounds(rows.select(*order))
    placed = rows.select(numbering._range_of([F.col(c) for c in order], bounds).alias("r"))
    sizes = [r["count"] for r in placed.groupBy("r").count().collect()]
    assert len(sizes) == len(bounds) + 1 and max(sizes) < 60_000 / 10
    numbered = with_row_number(rows, order, "n")
    expected = numbered.withColumn("m", F.row_number().over(Window.orderBy(*(F.asc_nulls_last(c) for c in order))))
    assert expected.filter("n <> m").count() == 0


def test_numbering_writes_nothing(spark, tables, tmp_path, monkeypatch):
    before = set(os.listdir(shared_dir(spark)))
    assert staging.stage_trips(tables.fact).count() == tables.fact.count()
    assert set(os.listdir(shared_dir(spark))) == before


def test_row_number_with_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "k int")
    assert sorted((r.n, r.k) for r in with_row_number(df, ["k"], "n").collect()) == [
        (1, 1), (2, 2), (3, None)
    ]
    assert with_row_number(df.limit(0), ["k"], "n").count() == 0


def test_row_number_over_midnight(spark):
    night = datetime(2024, 1, 7, 23, 59)
    f = fact(spark, *(
        {"tpep_pickup_datetime": night + timedelta(minutes=m), "PULocationID": z,
         "tpep_dropoff_datetime": night + timedelta(minutes=30)}
        for m, z in product((0, 0, 1, 1), (9, 3))
    ))
    rows = staging.stage_trips(f).orderBy("trip_id").collect()
    assert [r.trip_id for r in rows] == list(range(1, 9))
    assert [(r.pickup_datetime, r.pickup_location_id) for r in rows] == sorted(
        (r.pickup_datetime, r.pickup_location_id) for r in rows
    )


def enriched(spark, rows):
    columns = ("pickup_location_id int, payment_type int, pickup_date date, total_amount double, "
               "fare_amount double, tip_percentage double, trip_distance double, "
               "trip_duration_minutes double, weather_category string, pickup_hour int")
    day = datetime(2024, 1, 7).date()
    return spark.createDataFrame(
        [(z, pay, day, amount, 5.0, tip, 1.0, 10.0, category, 8)
         for z, pay, amount, tip, category in rows], columns)


def test_high_value_criteria(spark):
    def zone(ident, n, amount, tip, pay=1):
        return [(ident, pay, amount, tip, "Clair")] * n

    rows = [
        *zone(1, 10, 31.0, 16.0),      # meets all three
        *zone(2, 9, 100.0, 16.0),      # one trip short
        *zone(3, 10, 30.0, 16.0),      # exactly 300
        *zone(4, 10, 31.0, 15.0),      # exactly 15 percent
        *zone(5, 10, 30.01, 15.01),    # just above both
        *zone(6, 10, 31.0, 16.0, 2),   # cash
        *zone(7, 10, 31.0, None),      # no tip figures
    ]
    found = marts.high_value_zones(enriched(spark, rows)).collect()
    assert [r.pickup_location_id for r in found] == [1, 5]


def test_dominant_weather_tie_and_nulls(spark):
    labels = ["b", "a", "b", "a", None, None, None] * 2
    rows = [(1, 1, 100.0, 20.0, c) for c in labels]
    assert marts.high_value_zones(enriched(spark, rows)).first().dominant_weather == "a"


def test_hot_hour_median_is_exact(spark):
    """Two thirds of the rows in one hour; the median counts every one of them."""
    base = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 24).otherwise(8).cast("int").alias("pickup_hour"),
        F.to_date(F.lit("2024-01-07")).alias("pickup_date"),
        F.lit("Clair").alias("weather_category"),
        (F.pmod(F.hash("id"), F.lit(17900)) / 100 + 1).alias("trip_duration_minutes"),
        *(F.lit(1.5).alias(c) for c in ("tip_percentage", "fare_amount", "total_amount",
                                        "trip_distance", "temp_celsius", "wind_speed_ms")),
        F.lit(60).alias("humidity_pct"),
    ).cache()
    summary = {r.pickup_hour: r for r in marts.trip_summary(base).collect()}
    hot = [r[0] for r in base.filter("pickup_hour = 8").select("trip_duration_minutes").collect()]
    assert summary[8].trip_count == len(hot)
    assert summary[8].median_duration_min == pytest.approx(statistics.median(hot), abs=0.05001)
    assert summary[8].total_revenue == 1.5 * len(hot)


def test_semi_join_equals_inner_join(tables):
    zones = tables.zones.select("pickup_location_id")
    semi = joins.from_zones(tables.enriched, zones).select("pickup_datetime", "pickup_location_id")
    inner = tables.enriched.join(zones, "pickup_location_id").select(*semi.columns)
    assert sorted(semi.collect()) == sorted(inner.collect())


def test_histogram_edges(spark):
    def bins(values):
        df = spark.createDataFrame([(v,) for v in values], "trip_duration_minutes double")
        return [(r.bin, r.trips) for r in questions.duration_histogram(df).collect()]

    assert bins([1.0, 60.0, 60.0]) == [(1, 1), (60, 2)]
    assert bins([5.0, 5.0]) == [(1, 2)]
    assert bins([]) == []
    spread = bins([1 + i * 0.59 for i in range(101)])
    assert sum(n for _, n in spread) == 101 and spread[-1][0] == 60


def test_top_hours_prefer_the_earlier_of_equals(spark):
    start = datetime(2024, 1, 7)
    f = fact(spark, *(
        {"tpep_pickup_datetime": start + timedelta(hours=h),
         "tpep_dropoff_datetime": start + timedelta(hours=h, minutes=9)}
        for h in (20, 6, 9, 9, 13)
    ))
    assert [r.pickup_hour for r in questions.busiest_hours(f).collect()] == [9, 6, 13]


def test_sample_is_a_share_and_the_same_again(tables):
    everything = questions.duration_sample(tables.fact, 1).count()
    some = sorted(r[0] for r in questions.duration_sample(tables.fact, 4).collect())
    assert 0 < len(some) < everything
    assert some == sorted(r[0] for r in questions.duration_sample(tables.fact.repartition(5), 4).collect())


def test_stddev_matches_the_definition(spark):
    tips = [0.0, 10.0, 20.0, 20.0, 33.33, None]
    rows = [(1, 1, 10.0, t, "Clair") for t in tips] + [(1, 1, 10.0, 7.0, "Pluvieux")]
    found = {r.weather_category: r for r in questions.tips_by_weather(enriched(spark, rows)).collect()}
    assert found["Clair"].std_tip == round(statistics.stdev(tips[:-1]), 2)
    assert found["Clair"].median_tip == 20.0
    assert found["Clair"].pct_untipped == 16.67
    assert found["Pluvieux"].std_tip is None


def test_questions_work_on_empty_tables(tables):
    nothing = tables.enriched.limit(0)
    assert questions.duration_stats(nothing).first().median_min is None
    assert questions.tip_correlation(nothing).first().correlation is None
    assert questions.premium_peak_hour(nothing, marts.high_value_zones(nothing)).first().peak_hour is None
