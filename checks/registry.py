"""Every query of the engine, over the tables of one data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import replace
from datetime import timedelta
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stormfare.bindings import event_trips, event_weather, order_line_trips
from stormfare.config import Settings, settings_for_years
from stormfare.functions.exact import mean, merged_mean, merged_total, partial, total
from stormfare.functions.time import iso_weekday
from stormfare.functions.trip import payment_label
from stormfare.operators import quality, sketches, trips as trip_ops, weather as weather_ops
from stormfare.operators.joins import from_zones, join_hourly
from stormfare.plans import jobs, marts, questions, staging
from stormfare.schemas import FACT_TRIPS
from stormfare.session import delete, scratch_path, written
from stormfare.sinks.tables import write_table
from stormfare.sources import catalog, layout, manifest, spine
from stormfare.sources.trips import read_trips, validate_files, validate_months
from stormfare.sources.weather_json import LINES, input_report, read_weather, union_by_name
from stormfare.streaming import weather_stream

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = Settings()
# Order lines ship over these years.
LINE_SETTINGS = settings_for_years(1995, range(1995, 2003))
#: About as many observations go to one pretty file.
PRETTY_ROWS = 10_000
BUCKETS = 16
#: Durations of the fixed-size sample: fewer than the trips of any folder but the smallest.
PLOT_ROWS = 500
LINEAGE = ("ingested_at", "source_file")  # differ from run to run


class Tables:
    """The feeds and curated tables of one data folder, each defined on first use."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._given: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        """A table of the folder; its footer is read once."""
        if name not in self._given:
            self._given[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._given[name]

    @cached_property
    def raw_trips(self) -> DataFrame:
        return event_trips(self.given("events"))

    @cached_property
    def raw_weather(self) -> DataFrame:
        return event_weather(self.given("events"))

    @cached_property
    def clean(self) -> DataFrame:
        return trip_ops.clean(self.raw_trips, SETTINGS)

    @cached_property
    def fact(self) -> DataFrame:
        return trip_ops.fact_trips(self.clean, SETTINGS)

    @cached_property
    def weather(self) -> DataFrame:
        return weather_ops.dim_weather(self.raw_weather)

    @cached_property
    def staged_trips(self) -> DataFrame:
        return staging.stage_trips(self.fact)

    @cached_property
    def staged_weather(self) -> DataFrame:
        return staging.stage_weather(self.weather)

    @cached_property
    def enriched(self) -> DataFrame:
        """Enriched trips without a number, which most questions do not need."""
        return marts.enrich_trips(self.fact, self.staged_weather, SETTINGS)

    @cached_property
    def summary(self) -> DataFrame:
        return marts.trip_summary(self.enriched)

    @cached_property
    def zones(self) -> DataFrame:
        return marts.high_value_zones(self.enriched)

    @cached_property
    def line_fact(self) -> DataFrame:
        raw = order_line_trips(self.given("lineitem"))
        return trip_ops.fact_trips(trip_ops.clean(raw, LINE_SETTINGS), LINE_SETTINGS)

    @cached_property
    def curated(self) -> dict[str, DataFrame]:
        return {
            "fact_trips": self.fact,
            "dim_weather": self.weather,
            "trip_enriched": self.enriched,
            "trip_summary_per_hour": self.summary,
            "high_value_customers": self.zones,
        }


# --- Trips ---------------------------------------------------------------------


def enrich_trips(t: Tables) -> DataFrame:
    return trip_ops.enrich(t.clean, SETTINGS)


def time_dims(t: Tables) -> DataFrame:
    dated = trip_ops.add_time_dimensions(t.clean)
    return dated.withColumn("pickup_iso_weekday", iso_weekday("tpep_pickup_datetime")).select(
        "tpep_pickup_datetime", "pickup_hour", "pickup_day_of_week", "pickup_iso_weekday",
        "pickup_date", "pickup_month",
    )


def payment_lookup(t: Tables) -> DataFrame:
    return (
        t.raw_trips.groupBy("payment_type")
        .agg(F.count(F.lit(1)).alias("trips"))
        .withColumn("payment_type_desc", payment_label("payment_type"))
    )


# --- Weather -------------------------------------------------------------------


def weather_flat(t: Tables) -> DataFrame:
    return weather_ops.flatten(t.raw_weather).drop(*LINEAGE)


def weather_category(t: Tables) -> DataFrame:
    flat = weather_ops.flatten(t.raw_weather)
    return flat.groupBy("weather_main", "weather_category").agg(
        F.count(F.lit(1)).alias("observations")
    )


def _observed_at() -> Column:
    return F.col("`_metadata`.collected_at_iso").cast("timestamp_ntz")


def weather_union_by_name(t: Tables) -> DataFrame:
    """Two half months, the first from a feed without wind direction and visibility."""
    timed = t.raw_weather.withColumn("day", F.dayofmonth(_observed_at()))
    first = timed.filter(F.col("day") <= 15)
    second = timed.filter(F.col("day") > 15)
    narrow = first.withColumn("wind", F.col("wind").dropFields("deg")).drop("visibility")
    return union_by_name([second, narrow]).select(
        F.col("id").alias("observation_id"),
        F.col("wind.speed").alias("wind_speed"),
        F.col("wind.deg").alias("wind_deg"),
        "visibility",
    )


def _weather_files(t: Tables, levels: int = 3) -> Settings:
    """Write the raw weather as JSON by date; settings that read it."""
    path = scratch_path(t.spark, "weather-json")
    with_time = t.raw_weather.withColumn("_ts", _observed_at())
    parts = layout.with_partitions(with_time, "_ts", levels).drop("_ts")
    names = layout.PARTITIONS[:levels]
    parts.hint("rebalance", *names).write.partitionBy(*names).json(path)
    return replace(SETTINGS, weather_path=path)


def _pretty_weather(t: Tables) -> Settings:
    """January's weather as pretty files, as many to a day as its rows need, with a broken file and one with a broken field."""
    path = scratch_path(t.spark, "weather-pretty")
    dated = layout.with_partitions(t.raw_weather.withColumn("_ts", _observed_at()), "_ts").drop("_ts")
    fields = [F.col(f"`{c}`") for c in t.raw_weather.columns]
    text = F.to_json(F.struct(*fields), {"pretty": "true"})
    whole = F.concat(F.lit("[\n"), F.array_join(F.collect_list(text), ",\n"), F.lit("\n]"))
    counts = dated.groupBy(*[F.col(c).alias(f"_{c}") for c in layout.PARTITIONS]).agg(
        F.ceil(F.count(F.lit(1)) / PRETTY_ROWS).alias("_files"))
    bucket = F.pmod(F.xxhash64("id"), F.col("_files"))
    same_day = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in layout.PARTITIONS])
    split = dated.join(counts, same_day).withColumn("_bucket", bucket)
    files = split.groupBy(*layout.PARTITIONS, "_bucket").agg(whole.alias("value")).drop("_bucket")
    # One row is one file.
    files.write.option("maxRecordsPerFile", 1).partitionBy(*layout.PARTITIONS).text(path)
    first = t.raw_weather.orderBy("id").limit(1).select(text.alias("value"))
    broken = {
        "file": F.substring("value", 1, 40),
        "field": F.regexp_replace("value", r'"temp" : [-0-9.E]+', '"temp" : "warm"'),
    }
    for name, value in broken.items():
        first.select(value.alias("value")).coalesce(1).write.text(f"{path}/year={SETTINGS.year}/month=1/{name}")
    return replace(SETTINGS, months=(1,), weather_path=path)


def weather_json_scan(t: Tables) -> DataFrame:
    read = read_weather(t.spark, _pretty_weather(t))
    return weather_ops.dim_weather(read.observations).drop(*LINEAGE)


def weather_json_report(t: Tables) -> DataFrame:
    """Rows kept, quarantined and dropped, by the batch reader and by the stream."""
    settings = _pretty_weather(t)
    path = scratch_path(t.spark, "stream-table")
    raw = weather_stream.read_weather_stream(t.spark, settings.weather_path, pattern="*.txt")
    weather_stream.run_available(raw, path, scratch_path(t.spark, "stream-state"))
    both = {"batch": input_report(read_weather(t.spark, settings)),
            "stream": weather_stream.stream_report(t.spark, path)}
    reports = [df.select(F.lit(name).alias("reader"), "kept", "quarantined", "dropped") for name, df in both.items()]
    return reports[0].unionByName(reports[1])


def hour_spine(t: Tables) -> DataFrame:
    return spine.observed_hours(t.weather, "observation_hour")


def missing_hours(t: Tables) -> DataFrame:
    """Hours of the whole period without an observation."""
    hours = spine.period_hours(t.spark, SETTINGS)
    return spine.missing_hours(hours, t.weather, "observation_hour")


# --- Staging, joins and marts ----------------------------------------------------


def numbered_enriched(t: Tables) -> DataFrame:
    return marts.enrich_trips(t.staged_trips, t.staged_weather, SETTINGS)


def inner_weather_join(t: Tables) -> DataFrame:
    return join_hourly(t.fact, t.weather.drop(*LINEAGE), SETTINGS, "inner").select(
        "pickup_datetime", "pickup_location_id", "observation_hour", "temp_celsius"
    )


def premium_trips(t: Tables) -> DataFrame:
    return from_zones(t.enriched, t.zones).select(
        "pickup_datetime", "pickup_location_id", "total_amount", "weather_category"
    )


def sql_over_views(t: Tables) -> DataFrame:
    """Tables by name, which leaves the session's views alone."""
    return catalog.query(
        t.spark,
        """SELECT weather_category, count(*) AS hours
           FROM {stg_weather}
           WHERE obs_date IN (SELECT pickup_date FROM {fact_trips})
           GROUP BY weather_category""",
        stg_weather=t.staged_weather, fact_trips=t.fact,
    )


def catalog_views(t: Tables) -> DataFrame:
    """The staged weather through a view of the catalog, from a session that knows no frame of this one."""
    settings = replace(SETTINGS, warehouse=scratch_path(t.spark, "warehouse"))
    jobs.load_weather(t.raw_weather, settings)
    database = f"weather_{uuid.uuid4().hex}"
    jobs.declare(t.spark, settings, database, ("dim_weather",))
    return t.spark.newSession().table(f"{database}.stg_weather").drop("ingested_at")


def bucketed_enriched(t: Tables) -> DataFrame:
    """Enriched trips from tables dealt into equal buckets of date and hour: the trips are not shuffled."""
    database, path = f"buckets_{uuid.uuid4().hex}", scratch_path(t.spark, "buckets")
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    catalog.write_bucketed(t.fact, f"{database}.fact_trips", f"{path}/trips", ["pickup_date", "pickup_hour"], BUCKETS)
    catalog.write_bucketed(t.weather, f"{database}.dim_weather", f"{path}/weather", ["obs_date", "obs_hour"], BUCKETS)
    weather = staging.stage_weather(t.spark.table(f"{database}.dim_weather"))
    return marts.enrich_trips(t.spark.table(f"{database}.fact_trips"), weather, SETTINGS)


def sketch_distinct(t: Tables) -> DataFrame:
    """Distinct totals per hour of the day from summaries per hour and zone, held against the exact number."""
    summaries = sketches.summarize(t.fact, "total_amount", "trip_duration_minutes")
    stored = written(summaries, "summaries")
    exact = t.fact.groupBy("pickup_hour").agg(F.count_distinct("total_amount").alias("exact"))
    both = sketches.merged(stored, ["pickup_hour"]).join(exact, "pickup_hour")
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(
        F.col("exact") * sketches.DISTINCT_ERROR, F.lit(1.0))
    return both.select("pickup_hour", "rows", "exact", near.alias("within_error"))


def sketch_median(t: Tables) -> DataFrame:
    """Median durations per zone from summaries per hour and zone: whether the ranks are within the stated error."""
    stored = written(sketches.summarize(t.fact, "total_amount", "trip_duration_minutes"), "summaries")
    medians = sketches.merged(stored, ["pickup_location_id"]).select(
        "pickup_location_id", "rows", F.col("quantile").alias("median"))
    below = F.count_if(F.col("trip_duration_minutes") < F.col("median")) / F.count(F.lit(1))
    up_to = F.count_if(F.col("trip_duration_minutes") <= F.col("median")) / F.count(F.lit(1))
    ranked = t.fact.select("pickup_location_id", "trip_duration_minutes").join(medians, "pickup_location_id")
    # A sketch of few values gives the middle one itself.
    within = (below <= 0.5 + sketches.RANK_ERROR) & (up_to >= 0.5 - sketches.RANK_ERROR)
    return ranked.groupBy("pickup_location_id", "rows").agg(within.alias("within_error"))


def fine_totals(t: Tables) -> DataFrame:
    """Totals and averages of a column with eight decimals, in one step and in two."""
    events = t.given("events").select("event_type", "user_id", (F.rint(F.col("value") * 1e8 / 7) / 1e8).alias("fine"))
    whole = events.groupBy("event_type").agg(total("fine", 8, 8).alias("total"), mean("fine", 6, 8).alias("average"))
    users = events.groupBy("event_type", "user_id").agg(*partial("fine", decimals=8)).groupBy("event_type").agg(
        merged_total("fine", 8, 8).alias("merged_total"), merged_mean("fine", 6, 8).alias("merged_average"))
    return whole.join(users, "event_type")


def placed(df: DataFrame) -> DataFrame:
    """The place of each row as the result's own order gives it; few rows."""
    return df.withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))


# --- Quality and files ------------------------------------------------------------


def quality_suite(t: Tables) -> DataFrame:
    """The 25 tests over stored tables, as the batch run has them."""
    settings = replace(SETTINGS, warehouse=scratch_path(t.spark, "warehouse"))
    jobs.load_trips(t.raw_trips, settings)
    jobs.load_weather(t.raw_weather, settings)
    jobs.build_marts(t.spark, settings)
    return jobs.verify(t.spark, settings)[0]


def quality_of_writes(t: Tables) -> DataFrame:
    """The 25 tests as the writes of a run counted them; only three read a table."""
    settings = replace(SETTINGS, warehouse=scratch_path(t.spark, "warehouse"))
    writes = {"fact_trips": jobs.load_trips(t.raw_trips, settings)[0], "dim_weather": jobs.load_weather(t.raw_weather, settings)}
    writes.update(jobs.build_marts(t.spark, settings))
    return jobs.verify_writes(t.spark, settings, writes)[0]


def period_loads(t: Tables) -> DataFrame:
    """Order lines of one year, then of the next, then of the first again: both years stay."""
    warehouse = scratch_path(t.spark, "warehouse")
    raw = order_line_trips(t.given("lineitem"))
    for year in (1995, 1996, 1995):
        jobs.load_trips(raw, settings_for_years(year, [year], warehouse=warehouse))
    fact = jobs.stored(t.spark, replace(SETTINGS, warehouse=warehouse), "fact_trips")
    return fact.groupBy(F.year("pickup_date").alias("year"), F.col("pickup_month").alias("month")).agg(
        F.count(F.lit(1)).alias("trips"))


def relationship_check(t: Tables) -> DataFrame:
    """Trip hours' dates that the weather dimension lacks, and zones that are not premium."""
    checks = [
        quality.Check("fact_trips", "pickup_date", quality.RELATION,
                      parent=("dim_weather", "obs_date")),
        quality.Check("fact_trips", "pickup_location_id", quality.RELATION,
                      parent=("high_value_customers", "pickup_location_id")),
    ]
    return quality.run_suite(t.curated, checks)


def row_count_gate(t: Tables) -> DataFrame:
    floors = {"fact_trips": SETTINGS.min_fact_rows, "dim_weather": SETTINGS.min_weather_rows}
    return quality.row_count_gate(t.curated, floors)


def contract_violations(t: Tables) -> DataFrame:
    return t.fact.agg(F.count(F.lit(1)).alias("rows"), *FACT_TRIPS.violations())


def _trip_files(t: Tables) -> Settings:
    """Write the raw trips by date; settings that read them."""
    path = scratch_path(t.spark, "trips")
    layout.write_by_date(t.raw_trips, path, "tpep_pickup_datetime")
    return replace(SETTINGS, trip_path=path)


def trip_files_by_day(t: Tables) -> DataFrame:
    """Raw trips written by date and read back; months without files are left out."""
    path = _trip_files(t).trip_path
    files = t.spark.read.parquet(path).filter(layout.in_months(SETTINGS))
    return files.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("trips"), total("fare_amount", 2).alias("fares")
    )


def trip_file_scan(t: Tables) -> DataFrame:
    """The reader over folders that disagree on types, through to the bucket counts."""
    path = scratch_path(t.spark, "trips-mixed")
    third = F.dayofmonth("tpep_pickup_datetime") % 3
    for part, kind in enumerate(("bigint", "double", "smallint")):
        rows = t.raw_trips.filter(third == part).withColumn(
            "passenger_count", F.col("passenger_count").cast(kind))
        rows.write.parquet(f"{path}/2024/01/part{part}")
    settings = replace(SETTINGS, months=(1,), trip_path=path)
    fact = trip_ops.fact_trips(
        trip_ops.clean(read_trips(t.spark, settings, plain=True), settings), settings
    )
    return questions.bucket_counts(fact)


def _whole_files(t: Tables) -> Settings:
    """All trips by day; beside them files without fares, a file of text, an empty file, and a month that is not there."""
    path = scratch_path(t.spark, "trips-whole")
    layout.write_by_date(t.raw_trips, path, "tpep_pickup_datetime")
    month = f"{path}/year={SETTINGS.year}/month="
    t.raw_trips.drop("fare_amount").write.parquet(f"{month}2/unpriced")
    t.raw_trips.limit(1).withColumn("fare_amount", F.lit("free")).write.parquet(f"{month}2/text")
    t.raw_trips.limit(0).write.parquet(f"{month}3/none")
    return replace(SETTINGS, months=(1, 2, 3, 4), trip_path=path)


def schema_validation(t: Tables) -> DataFrame:
    """What is wrong with the files of each folder, over all trips."""
    folder = F.regexp_extract("file", "([^/]+)/[^/]+$", 1).alias("folder")
    checked = validate_files(t.spark, _whole_files(t))
    return checked.groupBy("month", folder, "error", "status").agg(F.sum("rows").alias("rows"))


def ingest_report(t: Tables) -> DataFrame:
    """The ingestion report over all trips."""
    return manifest.ingest_summary(validate_months(t.spark, _whole_files(t)).drop("files"))


def ingest_sizes(t: Tables) -> DataFrame:
    """The ingestion report with sizes per month, over all trips."""
    settings = _whole_files(t)
    sizes = manifest.month_sizes(manifest.file_manifest(t.spark, settings.trip_path))
    summary = manifest.ingest_summary(validate_months(t.spark, settings).join(sizes, "month", "left"))
    return summary.withColumn("size_mb", F.col("size_mb") >= 0).withColumnRenamed("size_mb", "has_size")


def file_manifest(t: Tables) -> DataFrame:
    """Rows of every folder as the digests counted them, and whether all its files have a digest."""
    folders = manifest.folder_manifest(manifest.file_manifest(t.spark, _trip_files(t).trip_path))
    return folders.select("file", "rows", F.col("digest").isNotNull().alias("digested"))


def _reloaded(t: Tables) -> tuple[str, DataFrame]:
    """A table of all days but one after reloads, and its manifest before: a day as it was, one changed, one added, one taken away."""
    path = scratch_path(t.spark, "trips-reloaded")
    day = F.dayofmonth("tpep_pickup_datetime")

    def load(rows: DataFrame) -> None:
        (layout.with_partitions(rows, "tpep_pickup_datetime").repartition("year", "month", "day")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year", "month", "day").parquet(path))

    load(t.raw_trips.filter(day != 16))
    before = written(manifest.update_manifest(t.spark, path).drop("fresh"), "manifest-before")
    load(t.raw_trips.filter(day == 2))
    load(t.raw_trips.filter(day == 5).withColumn("fare_amount", F.col("fare_amount") + 1))
    load(t.raw_trips.filter(day == 16))
    for month in SETTINGS.months:
        delete(t.spark, f"{path}/year={SETTINGS.year}/month={month}/day=7")
    return path, before


def manifest_comparison(t: Tables) -> DataFrame:
    """Folders by state after the reloads."""
    path, before = _reloaded(t)
    after = manifest.folder_manifest(manifest.update_manifest(t.spark, path, before))
    states = manifest.compare_manifests(manifest.folder_manifest(before), after)
    return states.groupBy("state").agg(F.count(F.lit(1)).alias("folders"))


def manifest_refresh(t: Tables) -> DataFrame:
    """Folders whose files the new manifest had to open, with their rows."""
    path, before = _reloaded(t)
    fresh = manifest.update_manifest(t.spark, path, before).filter("fresh")
    return manifest.folder_manifest(fresh).select(F.col("file").alias("folder"), "rows")


def manifest_tree(t: Tables) -> DataFrame:
    """Folders of the differing branches, from the whole table down to days."""
    path, before = _reloaded(t)
    after = manifest.update_manifest(t.spark, path, before)
    return manifest.differing_folders(manifest.digest_tree(before), manifest.digest_tree(after), 3)


def feed_fingerprint(t: Tables) -> DataFrame:
    """One digest of the whole feed; times and amounts as whole numbers, which every engine writes alike."""
    events = t.given("events")
    plain = events.withColumns({
        "ts": F.unix_micros(F.col("ts").cast("timestamp")),
        "value": F.rint(F.col("value") * 1e6).cast("long"),
    })
    return plain.agg(*manifest.row_fingerprint(*sorted(plain.columns)))


# --- Sinks -------------------------------------------------------------------------


def write_report(t: Tables) -> DataFrame:
    """Rows written, as counted by the write itself."""
    report = write_table(
        t.fact, scratch_path(t.spark, "fact"), FACT_TRIPS,
        partition_by=("pickup_date",), gather=True, sort_by=("pickup_datetime",),
    )
    return t.spark.createDataFrame(
        [("fact_trips", report.rows)], "table_name string, rows long"
    )


def period_reload(t: Tables) -> DataFrame:
    """Write all dates, load the second half again, twice: nothing may change."""
    path = scratch_path(t.spark, "reload")
    write_table(t.fact, path, FACT_TRIPS, ("pickup_date",), gather=True)
    late = t.fact.filter(F.dayofmonth("pickup_date") > 15)
    for _ in range(2):
        write_table(
            late, path, FACT_TRIPS, ("pickup_date",), gather=True, only_these_partitions=True
        )
    return (
        t.spark.read.parquet(path)
        .groupBy("pickup_date")
        .agg(F.count(F.lit(1)).alias("trips"), total("total_amount", 2).alias("revenue"))
    )


# --- Streaming -----------------------------------------------------------------------


def stream_weather_dedup(t: Tables) -> DataFrame:
    """The feed as a stream, run twice; the second run finds nothing new."""
    folder = _weather_files(t, levels=2).weather_path
    path = scratch_path(t.spark, "stream-table")
    checkpoint = scratch_path(t.spark, "stream-state")
    for _ in range(2):
        raw = weather_stream.read_weather_stream(t.spark, folder, LINES)
        weather_stream.run_available(raw, path, checkpoint)
    return t.spark.read.parquet(path).drop("observation_id", *LINEAGE)


def _late_parts(t: Tables) -> Iterator[DataFrame]:
    """What three triggers bring; the third an hour of the third day, long after hours were closed."""
    seen = _observed_at()
    late = (F.dayofmonth(seen) == 3) & (F.hour(seen) == 5)
    early = F.dayofmonth(seen) <= 10
    for part in (early & ~late, ~early & ~late, late):
        yield t.raw_weather.filter(part)


def _closed_hours(t: Tables) -> str:
    """An hourly table whose hours close two hours after their end, from the same three triggers."""
    folder, path = scratch_path(t.spark, "weather-late"), scratch_path(t.spark, "stream-closed")
    state = scratch_path(t.spark, "stream-state")
    for part in _late_parts(t):
        part.write.mode("append").json(folder)
        raw = weather_stream.read_weather_stream(t.spark, folder, LINES)
        weather_stream.run_available(raw, path, state, timedelta(hours=2))
    return path


def stream_late_rows(t: Tables) -> DataFrame:
    """Observations that came after their hour was closed."""
    late = weather_stream.late_rows(t.spark, _closed_hours(t))
    return late.groupBy("observation_hour").agg(F.count(F.lit(1)).alias("observations"))


def stream_late_report(t: Tables) -> DataFrame:
    """All rows of the feed by what became of them; hours of the table and those that only came late."""
    path = _closed_hours(t)
    hours = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("hours").alias("what"), "rows")
    counts = weather_stream.stream_report(t.spark, path)
    listed = F.explode(F.array(*(F.struct(F.lit(c).alias("what"), F.col(c).alias("rows")) for c in counts.columns)))
    return counts.select(listed.alias("one")).select("one.*").unionByName(hours)


def _stream_hours(t: Tables, build: Callable[[DataFrame], DataFrame], mode: str) -> DataFrame:
    """The updates of a stateful query over three triggers."""
    folder, out = scratch_path(t.spark, "weather-late"), scratch_path(t.spark, "stream-hours")
    state = scratch_path(t.spark, "stream-state")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    for part in _late_parts(t):
        part.write.mode("append").json(folder)
        raw = weather_stream.read_weather_stream(t.spark, folder, LINES)
        query = (
            build(raw).writeStream.outputMode(mode)
            .option("checkpointLocation", state)
            .foreachBatch(keep).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return t.spark.read.option("basePath", out).parquet(out)


def stream_first_arrivals(t: Tables) -> DataFrame:
    """Hours that had an arrival in time, and how often each came out; the late hour is dropped."""
    rows = _stream_hours(t, weather_stream.first_arrivals, "append")
    return rows.groupBy("observation_hour").agg(F.count(F.lit(1)).alias("times"))


def stream_hourly_state(t: Tables) -> DataFrame:
    """Latest state of each hour, from the updates of all micro-batches; the late hour is dropped."""
    updates = _stream_hours(t, weather_stream.hourly_state, "update")
    hours = weather_ops.first_per_hour(updates.drop("batch"))
    return hours.select("observation_hour", "observation_ts", "temp_celsius", "weather_category")


# --- Order-line feed -------------------------------------------------------------------


def line_hours(t: Tables) -> DataFrame:
    return questions.trips_by_hour(t.line_fact)


def line_trip_numbers(t: Tables) -> DataFrame:
    """Trip numbers of the larger feed, as totals per day; only the columns that takes are numbered."""
    return (
        staging.stage_trips(t.line_fact.select("pickup_date", *staging.TRIP_ORDER))
        .groupBy("pickup_date")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.min("trip_id").alias("first_id"),
            F.max("trip_id").alias("last_id"),
        )
    )


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # trips
    "raw_trips": lambda t: t.raw_trips,
    "clean_trips": lambda t: t.clean,
    "clean_rejects": lambda t: trip_ops.reject_report(t.raw_trips, SETTINGS),
    "enrich_trips": enrich_trips,
    "time_dims": time_dims,
    "fact_trips": lambda t: t.fact.drop(*LINEAGE),
    "payment_lookup": payment_lookup,
    # weather
    "weather_flat": weather_flat,
    "weather_category": weather_category,
    "weather_dedup": lambda t: t.weather.drop(*LINEAGE),
    "weather_dedup_report": lambda t: weather_ops.dedup_report(t.raw_weather),
    "weather_union_by_name": weather_union_by_name,
    "weather_json_scan": weather_json_scan,
    "weather_json_report": weather_json_report,
    "weather_stats": lambda t: weather_ops.global_stats(t.weather),
    "weather_category_counts": lambda t: weather_ops.category_counts(t.weather),
    "weather_category_share": lambda t: weather_ops.category_share(t.weather),
    "hour_spine": hour_spine,
    "missing_hours": missing_hours,
    # staging, joins and marts
    "stg_trips": lambda t: t.staged_trips.drop(*LINEAGE),
    "stg_weather": lambda t: t.staged_weather.drop("ingested_at"),
    "trip_enriched": numbered_enriched,
    "inner_weather_join": inner_weather_join,
    "premium_trips": premium_trips,
    "trip_summary_per_hour": lambda t: t.summary,
    "high_value_zones": lambda t: placed(t.zones),
    "table_counts": lambda t: marts.table_counts(t.curated),
    "sql_over_views": sql_over_views,
    "catalog_views": catalog_views,
    "bucketed_enriched": bucketed_enriched,
    "sketch_distinct": sketch_distinct,
    "sketch_median": sketch_median,
    # questions
    "fine_totals": fine_totals,
    "q1_stats": lambda t: questions.duration_stats(t.fact),
    "q1_histogram": lambda t: questions.duration_histogram(t.fact),
    "q1_buckets": lambda t: questions.bucket_counts(t.fact),
    "q1_sample": lambda t: questions.duration_sample(t.fact),
    "q1_sample_rows": lambda t: questions.duration_sample_of(t.fact, PLOT_ROWS),
    "q2_tips_by_bucket": lambda t: questions.tips_by_bucket(t.fact),
    "q2_tip_by_mile": lambda t: questions.tip_by_mile(t.fact),
    "q2_corr": lambda t: questions.tip_correlation(t.fact),
    "q3_hours": lambda t: placed(questions.trips_by_hour(t.fact)),
    "q3_top3": lambda t: questions.busiest_hours(t.fact),
    "q4_corr_by_bucket": lambda t: questions.correlation_by_bucket(t.fact),
    "q5_temp_by_hour": lambda t: questions.temperature_by_hour(t.fact, t.weather, SETTINGS),
    "q5_top3": lambda t: questions.temperature_at_peak(t.fact, t.weather, SETTINGS),
    "q6_weather_volume": lambda t: questions.volume_by_weather(t.summary),
    "q7_behaviour": lambda t: questions.behaviour_by_weather(t.enriched),
    "q8_premium_hours": lambda t: questions.premium_by_hour(t.enriched, t.zones),
    "q8_peak": lambda t: questions.premium_peak_hour(t.enriched, t.zones),
    "q8_top5": lambda t: questions.premium_top_hours(t.enriched, t.zones),
    "q9_weather_tips": lambda t: questions.tips_by_weather(t.enriched),
    # quality and files
    "quality_suite": quality_suite,
    "quality_of_writes": quality_of_writes,
    "period_loads": period_loads,
    "relationship_check": relationship_check,
    "row_count_gate": row_count_gate,
    "weather_gate": lambda t: quality.weather_gate(t.weather),
    "contract_violations": contract_violations,
    "trip_files_by_day": trip_files_by_day,
    "trip_file_scan": trip_file_scan,
    "schema_validation": schema_validation,
    "schema_validation_all": schema_validation,
    "ingest_report": ingest_report,
    "ingest_report_all": ingest_report,
    "ingest_sizes": ingest_sizes,
    "ingest_sizes_all": ingest_sizes,
    "file_manifest": file_manifest,
    "manifest_comparison": manifest_comparison,
    "manifest_comparison_all": manifest_comparison,
    "manifest_refresh": manifest_refresh,
    "manifest_tree": manifest_tree,
    "feed_fingerprint": feed_fingerprint,
    # sinks
    "write_report": write_report,
    "period_reload": period_reload,
    # streaming
    "stream_weather_dedup": stream_weather_dedup,
    "stream_first_arrivals": stream_first_arrivals,
    "stream_hourly_state": stream_hourly_state,
    "stream_late_rows": stream_late_rows,
    "stream_late_report": stream_late_report,
    # order-line feed
    "line_hours": line_hours,
    "line_trip_numbers": line_trip_numbers,
}


def _bind(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: build(Tables(spark, folder))


QUERIES: dict[str, Query] = {name: _bind(build) for name, build in _QUERIES.items()}
