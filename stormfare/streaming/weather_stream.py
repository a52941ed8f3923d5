"""Weather feed as a stream of files into an hourly table.

The batch stages run unchanged on each micro-batch. The table itself holds the
state: an observation that arrives late, however late, is merged with the hour
already stored, so stream and batch give the same table and no row is dropped
for lateness. Where a consumer wants hours to close, rows that come after that
are set aside and counted instead.

A micro-batch is parsed once: its rows are written flat, with what becomes of
each, while the same pass counts them; all further steps read that.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..operators.weather import first_per_hour, flatten, usable, valid
from ..schemas import CORRUPT_COLUMN
from ..session import delete, scratch_path
from ..sources.weather_json import LINES, PRETTY, WITH_CORRUPT, corrupt, readable, split_corrupt

PARTITION = "obs_date"


def read_weather_stream(
    spark: SparkSession, folder: str, style: str = PRETTY, max_files: int | None = None,
    pattern: str = "*.json",
) -> DataFrame:
    """New JSON files below a folder, as they arrive, with the text of what could not be read."""
    reader = (
        spark.readStream.schema(WITH_CORRUPT)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("multiLine", style != LINES)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder)


def observations(raw: DataFrame) -> DataFrame:
    """Valid observations; what is broken is left to :func:`split_corrupt`."""
    rows = split_corrupt(raw)[0] if CORRUPT_COLUMN in raw.columns else raw
    return rows.transform(flatten).transform(valid)


def _stored(path: str, like: DataFrame) -> DataFrame:
    """The table so far; an empty one is made before the first batch."""
    spark = like.sparkSession
    nothing = spark.createDataFrame([], like.schema)
    nothing.write.mode("ignore").partitionBy(PARTITION).parquet(path)
    return spark.read.schema(like.schema).parquet(path)


def merge_hours(batch: DataFrame, path: str) -> None:
    """Merge a batch into the hourly table; merging it again changes nothing.

    Only the dates of the batch are replaced, and only the folders between its
    first and last date are read. Both sides have one row per hour, so the
    result is small; it is written aside before the folders it was read from are
    replaced, and the tables written aside are deleted with the batch.
    """
    spark, aside = batch.sparkSession, scratch_path(batch.sparkSession, "weather-batch")
    try:
        _merge(batch, path, aside)
    finally:
        delete(spark, aside)


def _aside(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _merge(batch: DataFrame, path: str, aside: str) -> None:
    fresh = _aside(batch.transform(first_per_hour), f"{aside}/fresh")
    first, last = fresh.agg(F.min(PARTITION), F.max(PARTITION)).first()
    if first is None:
        return
    touched = fresh.select(PARTITION).distinct()
    kept = (
        _stored(path, fresh)
        .filter(F.col(PARTITION).between(F.lit(first), F.lit(last)))
        .join(touched, PARTITION, "left_semi")
        .select(*fresh.columns)
    )
    merged = _aside(fresh.unionByName(kept).transform(first_per_hour), f"{aside}/merged")
    (
        merged.repartition(PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def quarantine_path(path: str) -> str:
    """Where a hourly table's stream leaves what it could not read."""
    return f"{path.rstrip('/')}_quarantine"


COUNTS = ("kept", "quarantined", "dropped", "late")


def hours_closed_before(spark: SparkSession, path: str, batch: int, lateness: timedelta) -> datetime | None:
    """Hours that ended by then are closed for a batch: the latest moment of the batches before, less the lateness."""
    try:
        counts = spark.read.parquet(f"{quarantine_path(path)}/counts")
    except AnalysisException:  # no batch so far
        return None
    latest = counts.filter(F.col("batch") < batch).agg(F.max("latest")).first()[0]
    return None if latest is None else latest - lateness


def _sorted_out(batch: DataFrame, closed: datetime | None) -> DataFrame:
    """Flat rows of a batch with what becomes of each; one of which a field is broken is kept and quarantined."""
    marked = batch.withColumns({"_broken": corrupt(), "_readable": readable()})
    flat = flatten(marked, "_broken", "_readable", CORRUPT_COLUMN)
    sound = F.col("_readable") & usable()
    ended = F.col("observation_hour") + F.expr("INTERVAL 1 HOUR")
    late = F.lit(False) if closed is None else sound & (ended <= F.lit(closed).cast("timestamp_ntz"))
    return flat.withColumns({"_late": late, "_kept": sound & ~late, "_dropped": F.col("_readable") & ~sound})


def hourly_writer(raw: DataFrame, path: str, checkpoint: str, lateness: timedelta | None = None) -> DataStreamWriter:
    """Writer that merges every micro-batch into the hourly table.

    Broken rows go to the quarantine beside it, and each batch leaves its counts
    of rows kept, quarantined, dropped and late there too; a batch that runs
    again replaces its own. With ``lateness`` an hour is closed once a batch
    before had a moment so much later than its end: rows for it are left to
    :func:`late_rows` and do not change the table.
    """
    flags = ("_broken", "_readable", "_late", "_kept", "_dropped")

    def take(batch: DataFrame, number: int) -> None:
        spark, place = batch.sparkSession, quarantine_path(path)
        closed = None if lateness is None else hours_closed_before(spark, path, number, lateness)
        seen, aside = Observation(), scratch_path(spark, "weather-parsed")
        sorted_out = _sorted_out(batch, closed)
        counted = sorted_out.observe(
            seen, F.count_if("_kept").alias("kept"), F.count_if("_broken").alias("quarantined"),
            F.count_if("_dropped").alias("dropped"), F.count_if("_late").alias("late"),
            F.max(F.when(F.col("_kept") | F.col("_late"), F.col("observation_ts"))).alias("latest"))
        try:
            parsed = _aside(counted, aside)
            found = seen.get
            merge_hours(parsed.filter("_kept").drop(*flags, CORRUPT_COLUMN), path)
            parsed.filter("_broken").select(CORRUPT_COLUMN).write.mode("overwrite").parquet(f"{place}/rows/batch={number}")
            parsed.filter("_late").drop(*flags, CORRUPT_COLUMN).write.mode("overwrite").parquet(
                f"{place}/late/batch={number}")
            report = spark.createDataFrame(
                [tuple(found[c] for c in (*COUNTS, "latest"))],
                ", ".join([*(f"{c} long" for c in COUNTS), "latest timestamp_ntz"]))
            report.coalesce(1).write.mode("overwrite").parquet(f"{place}/counts/batch={number}")
        finally:
            delete(spark, aside)

    return raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take)


def stream_report(spark: SparkSession, path: str) -> DataFrame:
    """Rows kept, quarantined, dropped and late by all batches so far."""
    counts = spark.read.parquet(f"{quarantine_path(path)}/counts")
    return counts.agg(*(F.sum(c).alias(c) for c in COUNTS))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Observations of hours that were closed when they came, with the batch they came in."""
    return spark.read.parquet(f"{quarantine_path(path)}/late")


def run_available(raw: DataFrame, path: str, checkpoint: str, lateness: timedelta | None = None) -> StreamingQuery:
    """Process the files not seen before, then stop."""
    query = hourly_writer(raw, path, checkpoint, lateness).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def first_arrivals(raw: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Cheap variant: the first observation to arrive for each hour.

    The watermark lets old state go. Which row survives depends on arrival, and
    an hour seen again after the watermark passed it comes out again; use
    :func:`hourly_writer` where the table must equal the batch result.
    """
    # A watermark needs a zoned timestamp column; the wall clock stays beside it.
    timed = observations(raw).withColumn("event_time", F.col("observation_ts").cast("timestamp"))
    return timed.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(
        ["observation_hour"]
    )


def hourly_state(raw: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Stateful variant: the surviving observation of each hour, updated as the
    hour receives rows, with state kept until the watermark passes the hour."""
    timed = observations(raw).withColumn("event_time", F.col("observation_ts").cast("timestamp"))
    marked = timed.withWatermark("event_time", lateness)
    hour = F.window("event_time", "1 hour").alias("hour")
    survivor = F.min(F.struct(*_survivor_order(marked)))
    return marked.groupBy(hour).agg(survivor.alias("first")).select("first.*")


def _survivor_order(df: DataFrame) -> list[str]:
    lead = ["observation_ts", "observation_id"]
    return [*lead, *(c for c in df.columns if c not in (*lead, "event_time"))]
