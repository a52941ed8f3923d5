from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Observation, functions as F

from rows import trips
from stormfare.config import Settings, parse_months, settings_for_years
from stormfare.functions.exact import half_up, mean, pearson, total
from stormfare.functions.time import hour_start, iso_weekday
from stormfare.functions.trip import distance_bucket, payment_label
from stormfare.operators import trips as ops
from stormfare.schemas import FACT_TRIPS

S = Settings()


def kept(spark, *changes):
    return ops.clean(trips(spark, *changes), S).count()


@pytest.mark.parametrize("column, good, bad", [
    ("trip_distance", (0.1, 100.0), (0.09, 100.01, None)),
    ("fare_amount", (2.5, 500.0), (2.49, 500.01, None)),
    ("passenger_count", (1, 6), (0, 7, None)),
])
def test_range_filters_are_inclusive(spark, column, good, bad):
    assert kept(spark, *({column: v} for v in good)) == len(good)
    assert kept(spark, *({column: v} for v in bad)) == 0


def test_period_filter(spark):
    stay = timedelta(minutes=10)
    moments = [
        datetime(2023, 12, 31, 23, 59, 59), datetime(2024, 1, 1),
        datetime(2024, 3, 31, 23, 59, 59), datetime(2024, 4, 1),
    ]
    raw = trips(spark, *(
        {"tpep_pickup_datetime": m, "tpep_dropoff_datetime": m + stay} for m in moments
    ))
    found = [r[0] for r in ops.clean(raw, S).select("tpep_pickup_datetime").collect()]
    assert sorted(found) == moments[1:3]


def test_period_with_a_gap_has_two_ranges():
    assert len(Settings(months=(1, 3)).ranges) == 2
    assert Settings(months=(1, 2, 3)).ranges == ((datetime(2024, 1, 1), datetime(2024, 4, 1)),)
    assert Settings().hours == 2184
    assert parse_months("1, 02,3") == (1, 2, 3)
    assert Settings().month_labels == ("2024-01", "2024-02", "2024-03")
    assert settings_for_years(2020, range(2020, 2022)).ranges == (
        (datetime(2020, 1, 1), datetime(2022, 1, 1)),
    )


def test_dropoff_must_be_later(spark):
    same = datetime(2024, 1, 7, 14, 37)
    assert kept(spark, {"tpep_dropoff_datetime": same}) == 0
    assert kept(spark, {"tpep_dropoff_datetime": None}) == 0


def test_reject_report_counts_each_rule(spark):
    raw = trips(spark, {}, {"trip_distance": 0.0}, {"fare_amount": None, "passenger_count": 0})
    row = ops.reject_report(raw, S).first()
    assert (row.rows_in, row.rows_out, row.rows_rejected) == (3, 1, 2)
    assert (row.not_distance_in_range, row.not_fare_in_range, row.not_passengers_in_range) == (1, 1, 1)
    assert row.pct_rejected == 66.67
    assert ops.reject_report(raw.limit(0), S).first().pct_rejected == 0.0


def test_observed_counts_come_from_the_job(spark):
    metrics = Observation()
    ops.clean_observed(trips(spark, {}, {"trip_distance": 0.0}), S, metrics).collect()
    assert metrics.get["rows_in"] == 2 and metrics.get["rows_out"] == 1


@pytest.mark.parametrize("seconds, minutes", [(59, None), (60, 1.0), (10_800, 180.0), (10_801, None),
                                              (61, 1.02), (100, 1.67)])
def test_duration(spark, seconds, minutes):
    start = datetime(2024, 1, 7, 14, 37)
    raw = trips(spark, {"tpep_dropoff_datetime": start + timedelta(seconds=seconds)})
    rows = ops.enrich(raw, S).collect()
    assert [r.trip_duration_minutes for r in rows] == ([] if minutes is None else [minutes])


def test_duration_drops_parts_of_seconds_first(spark):
    start = datetime(2024, 1, 7, 14, 37, 0, 900_000)
    raw = trips(spark, {"tpep_pickup_datetime": start,
                        "tpep_dropoff_datetime": datetime(2024, 1, 7, 14, 38, 1, 100_000)})
    assert ops.enrich(raw, S).first().trip_duration_minutes == 1.02


def test_duration_ignores_clock_changes(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        raw = trips(spark, {"tpep_pickup_datetime": datetime(2024, 3, 10, 1, 50),
                            "tpep_dropoff_datetime": datetime(2024, 3, 10, 3, 10)})
        row = ops.enrich(raw, S).first()
        assert row.trip_duration_minutes == 80.0
        gap = trips(spark, {"tpep_pickup_datetime": datetime(2024, 3, 10, 2, 30)})
        hour = gap.select(hour_start("tpep_pickup_datetime")).first()[0]
        assert hour == datetime(2024, 3, 10, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_tip_percentage(spark):
    raw = trips(spark, {"tip_amount": None}, {"fare_amount": 0.0}, {"tip_amount": 2.01, "fare_amount": 8.0})
    tips = [r.tip_percentage for r in ops.enrich(raw, S).collect()]
    assert tips == [None, 0.0, 25.13]


def test_distance_bucket(spark):
    df = spark.createDataFrame([(m,) for m in (1.24, 1.25, 3.10, 3.11, None)], "m double")
    labels = [r[0] for r in df.select(distance_bucket("m")).collect()]
    assert labels == [">0-2km", "2-5km", "2-5km", ">5km", ">5km"]


def test_payment_label(spark):
    df = spark.createDataFrame([(c,) for c in (1, 6, 0, 7, None)], "c bigint")
    labels = [r[0] for r in df.select(payment_label("c")).collect()]
    assert labels == ["Credit card", "Voided trip", None, None, None]


def test_weekdays(spark):
    raw = trips(spark, {})  # a Sunday
    row = ops.add_time_dimensions(raw).withColumn("iso", iso_weekday("tpep_pickup_datetime")).first()
    assert (row.pickup_day_of_week, row.iso, row.pickup_hour, row.pickup_month) == (1, 7, 14, 1)
    assert row.pickup_date == date(2024, 1, 7)


def test_fact_has_the_contract(spark):
    fact = ops.fact_trips(trips(spark, {}), S)
    assert fact.columns == FACT_TRIPS.names and len(fact.columns) == 23
    assert [f.dataType for f in fact.schema] == [t for _, t in FACT_TRIPS.columns]


def test_period_filter_reaches_the_scan(spark, folder, capsys):
    trips(spark, {}).write.parquet(f"{folder}/t")
    ops.clean(spark.read.parquet(f"{folder}/t"), S).explain("formatted")
    plan = capsys.readouterr().out
    pushed = plan[plan.rindex("PushedFilters"):]
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed
    assert "LessThan(tpep_pickup_datetime" in pushed


@pytest.mark.parametrize("value, places, expected", [
    (1.005, 2, 1.01), (-1.005, 2, -1.01), (2.5, 0, 3.0), (-0.001, 2, 0.0), (0.125, 2, 0.13),
    (25.124999999999996, 2, 25.13), (6.2, 1, 6.2), (None, 2, None),
])
def test_half_up(spark, value, places, expected):
    got = spark.createDataFrame([(value,)], "x double").select(half_up("x", places)).first()[0]
    assert got == expected
    assert str(got) != "-0.0"


def test_totals_do_not_depend_on_partitioning(spark):
    df = spark.range(10_000).select((F.col("id") * 0.1).alias("x"), (F.col("id") % 7).alias("k"))
    results = {
        str(df.repartition(n).agg(total("x", 2), mean("x", 6)).first()) for n in (1, 3, 8)
    }
    assert len(results) == 1


def test_correlation_edges(spark):
    def corr(rows):
        return spark.createDataFrame(rows, "x double, y double").agg(pearson("x", "y", 4)).first()[0]

    assert corr([(1.0, 2.0)]) is None
    assert corr([(1.0, 2.0), (1.0, 3.0)]) is None
    assert corr([]) is None
    assert corr([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)]) == 1.0
    assert corr([(1.0, 2.0), (2.0, 4.0), (9.0, None), (None, 1.0)]) == 1.0
