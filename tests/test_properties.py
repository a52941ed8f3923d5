"""Random data against plain definitions, and properties of the plans."""

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.registry import QUERIES, SETTINGS, Tables
from stormfare.functions.exact import (
    half_up, mean, total, weight, weighted_mean, weighted_quantile, weighted_stddev,
)
from stormfare.operators import trips as trip_ops, weather as weather_ops
from stormfare.bindings import event_trips
from stormfare.operators.quantiles import group_quantile
from stormfare.plans import marts, questions

SMALL = "/root/testdata/sf0.001"


def rounded(value, places):
    exact = Decimal(repr(value)).quantize(Decimal(1).scaleb(-6), ROUND_HALF_UP)
    return float(exact.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


@pytest.mark.parametrize("places", [0, 1, 2, 4])
def test_half_up_equals_decimal_rounding(spark, places):
    rng = random.Random(places)
    values = [rng.uniform(-500, 500) for _ in range(1000)]
    values += [rng.randint(-10**6, 10**6) / 1000 for _ in range(3000)]  # many exact halves
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[1] for r in df.select("x", half_up("x", places)).collect()]
    assert got == [rounded(v, places) + 0.0 for v in values]


def test_two_step_aggregates_equal_their_definitions(spark):
    """One key holds most of the rows; values repeat, and some are missing."""
    rng = random.Random(7)
    rows = [
        ("hot" if rng.random() < 0.7 else rng.choice("abc"),
         None if rng.random() < 0.05 else rng.randint(0, 4000) / 100)
        for _ in range(6000)
    ] + [("one", 3.5), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    counts = df.groupBy("k", "v").agg(weight())
    figures = counts.groupBy("k").agg(
        weighted_mean("v", 4).alias("mean"),
        weighted_quantile("v", 0.5, 4).alias("median"),
        weighted_quantile("v", 0.75, 4).alias("p75"),
        weighted_stddev("v", 4).alias("std"),
    )
    for q, name in ((0.5, "ranked_median"), (0.9, "ranked_p90")):
        figures = figures.join(group_quantile(counts, ["k"], "v", q, 4, name), "k", "left")
    found = {r.k: r for r in figures.collect()}
    groups = defaultdict(list)
    for k, v in rows:
        groups[k] += [] if v is None else [v]
    for k, values in groups.items():
        r = found[k]
        if not values:
            assert (r["mean"], r.median, r.p75, r.std) == (None,) * 4
            assert (r.ranked_median, r.ranked_p90) == (None, None)
            continue
        assert r["mean"] == pytest.approx(np.mean(values), abs=6e-5)
        assert r.median == pytest.approx(np.median(values), abs=6e-5)
        assert r.p75 == pytest.approx(np.quantile(values, 0.75), abs=6e-5)
        assert r.ranked_median == r.median
        assert r.ranked_p90 == pytest.approx(np.quantile(values, 0.9), abs=6e-5)
        if len(values) == 1:
            assert r.std is None
        else:
            assert r.std == pytest.approx(np.std(values, ddof=1), abs=6e-5)


def test_large_totals_are_exact(spark):
    df = spark.range(1_000_000).select((F.col("id") % 2 * 0.01 + 49_999_999.99).alias("x"))
    row = df.agg(total("x", 2), mean("x", 3)).first()
    assert row[0] == 49_999_999_995_000.0
    assert row[1] == 49_999_999.995


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_fact_load_does_not_shuffle(spark, capsys):
    raw = event_trips(spark.read.parquet(f"{SMALL}/events.parquet"))
    fact = trip_ops.fact_trips(trip_ops.clean(raw, SETTINGS), SETTINGS)
    assert "Exchange" not in plan(fact, capsys)


def test_enriching_shuffles_only_the_weather(spark, capsys):
    t = Tables(spark, SMALL)
    text = plan(t.enriched, capsys)
    assert text.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(observation_hour" in text


def test_weather_is_reduced_before_the_shuffle(spark, capsys):
    t = Tables(spark, SMALL)
    text = plan(weather_ops.first_per_hour(weather_ops.flatten(t.raw_weather)), capsys)
    assert text.index("functions=[min(") < text.index("Exchange") < text.index("partial_min(")


def test_zones_keep_no_objects_per_trip(spark, capsys):
    t = Tables(spark, SMALL)
    assert "ObjectHashAggregate" not in plan(marts.high_value_zones(t.enriched), capsys)


def test_histogram_reads_the_trips_once(spark, capsys):
    t = Tables(spark, SMALL)
    assert plan(questions.duration_histogram(t.fact), capsys).count("FileScan") == 1


def test_no_window_over_all_tips_of_a_bucket(spark, capsys):
    t = Tables(spark, SMALL)
    text = plan(questions.tips_by_bucket(t.fact), capsys)
    windows = [line for line in text.splitlines() if " Window " in line and "tip_percentage" in line]
    assert windows and all("_bin" in line.split("[distance_bucket", 1)[1] for line in windows)


def test_suite_reads_each_table_once(spark, capsys):
    assert plan(QUERIES["quality_suite"](spark, SMALL), capsys).count("FileScan") == 5


def test_tests_carried_by_the_writes_leave_three_scans(spark, capsys):
    assert plan(QUERIES["quality_of_writes"](spark, SMALL), capsys).count("FileScan") == 3


def test_zones_read_the_trips_once(spark, capsys):
    text = plan(marts.high_value_zones(Tables(spark, SMALL).enriched), capsys)
    assert text.count("FileScan") == 2  # the trips and the weather


@pytest.mark.parametrize("name", ["q2_tips_by_bucket", "q9_weather_tips"])
def test_trips_are_read_once_for_counts_that_all_figures_share(spark, capsys, name):
    """What is planned reads the written counts; the events were read to write them."""
    text = plan(QUERIES[name](spark, SMALL), capsys)
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert scans and all("event_type" not in line for line in scans)


def test_premium_trips_are_summed_before_the_join(spark, capsys):
    t = Tables(spark, SMALL)
    text = plan(questions.premium_by_hour(t.enriched, marts.high_value_zones(t.enriched)), capsys)
    assert text.index("LeftSemi") < text.index("keys=[pickup_location_id")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream")])
def test_plans_have_no_cross_join_and_no_python(spark, capsys, name):
    text = plan(QUERIES[name](spark, SMALL), capsys)
    for operator in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas"):
        assert operator not in text
