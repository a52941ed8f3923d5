"""Benchmark: seconds per query at $BENCH_SF_DIR, and rows per second of the batch run.

Prints one JSON line. Each query is timed once, from defining it to its last
row, code compilation included. The batch run uses the events of the folder,
repeated to about ten million raw trips at sf0.1, since the folder alone is too
small to show throughput.
"""

from __future__ import annotations

import json
import os
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from checks.registry import QUERIES, SETTINGS
from stormfare.bindings import WEATHER_EVENT, event_trips, event_weather
from stormfare.plans import jobs
from stormfare.session import local_session, scratch_path, written
from stormfare.sources.layout import with_partitions
from stormfare.sources.spine import period_hours
from stormfare.sources.weather_json import read_weather

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
COPIES = int(os.environ.get("BENCH_COPIES", "120"))

HEADLINE = [
    "clean_rejects", "fact_trips", "weather_dedup", "stg_trips", "trip_enriched",
    "trip_summary_per_hour", "high_value_zones", "q1_stats", "q1_histogram", "q1_buckets",
    "q2_tips_by_bucket", "q2_tip_by_mile", "q2_corr", "q3_hours", "q3_top3",
    "q4_corr_by_bucket", "q5_temp_by_hour", "q5_top3", "q6_weather_volume", "q7_behaviour",
    "q8_premium_hours", "q8_peak", "q8_top5", "q9_weather_tips", "quality_suite", "line_hours",
    "line_trip_numbers",
]


def seconds(df: DataFrame) -> float:
    """Time to compute every row of a result, without keeping it."""
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def timed_query(spark: SparkSession, name: str) -> float:
    started = time.perf_counter()
    df = QUERIES[name](spark, FOLDER)
    return time.perf_counter() - started + seconds(df)


def weather_files(spark: SparkSession, events: DataFrame) -> str:
    """One pretty JSON file for each hour of the period, from as many weather events."""
    hours = period_hours(spark, SETTINGS)
    number = F.row_number().over(Window.orderBy("hour_start"))
    given = events.filter(F.col("event_type") == WEATHER_EVENT).drop("ts")
    count = given.count()
    numbered = given.withColumn("n", F.row_number().over(Window.orderBy("event_id")) % count)
    hourly = numbered.join(
        hours.select(F.col("hour_start").alias("ts"), (number % count).alias("n")), "n").drop("n")
    raw = event_weather(hourly)
    seen = F.col("`_metadata`.collected_at_iso").cast("timestamp_ntz")
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns]), {"pretty": "true"})
    files = with_partitions(raw.withColumn("_ts", seen).withColumn("value", text), "_ts", 2)
    path = scratch_path(spark, "bench-weather")
    (files.select("value", "year", "month").write.partitionBy("year", "month")
     .option("maxRecordsPerFile", 1).text(path))
    return path


def batch_run(spark: SparkSession) -> dict[str, float]:
    """Both feeds to verified marts; every copy of an event is a row of its own."""
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    copies = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    shift = F.col("copy") * 7919 % 86400
    spread = copies.withColumns({
        "event_id": F.col("event_id") * COPIES + F.col("copy"),
        "ts": F.timestamp_add("SECOND", shift, F.col("ts")),
    }).drop("copy")
    raw_trips = written(event_trips(spread).repartition(4 * CPUS), "bench-trips")
    weather_path = weather_files(spark, events)
    rows_in = raw_trips.count()
    settings = replace(
        SETTINGS, warehouse=scratch_path(spark, "bench-warehouse"), weather_path=weather_path)

    started = time.perf_counter()
    trips, _ = jobs.load_trips(raw_trips, settings)
    load = time.perf_counter() - started
    started = time.perf_counter()
    hours = jobs.load_weather(read_weather(spark, settings).observations, settings)
    weather = time.perf_counter() - started
    started = time.perf_counter()
    jobs.build_marts(spark, settings)
    marts = time.perf_counter() - started
    started = time.perf_counter()
    tests, _ = jobs.verify(spark, settings)
    tests.collect()
    verify = time.perf_counter() - started
    return {
        "rows_in": rows_in,
        "rows_written": trips.rows,
        "trip_job_sec": round(load, 2),
        "trip_job_rows_per_sec": round(trips.rows / load),
        "weather_files": hours.rows,
        "weather_job_sec": round(weather, 2),
        "marts_sec": round(marts, 2),
        "tests_sec": round(verify, 2),
    }


def main() -> None:
    spark = local_session(
        "bench", CPUS, shuffle_partitions=CPUS, **{"spark.driver.memory": "12g"}
    )
    timed_query(spark, "trip_summary_per_hour")  # start-up and code compilation
    queries = {name: round(timed_query(spark, name), 3) for name in HEADLINE}
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "batch_run": batch_run(spark) if COPIES else None,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
