"""Nested weather JSON: month-wise reading with reported failures."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..config import Settings
from ..operators.weather import flatten, usable
from ..schemas import CORRUPT_COLUMN, RAW_WEATHER
from .layout import month_folders

# One object over many lines per file, or one object per line (splittable).
PRETTY, LINES = "pretty", "lines"

WITH_CORRUPT = T.StructType([*RAW_WEATHER.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])


@dataclass
class WeatherInput:
    """What was read, which months could not be, and which rows were broken.

    A row of which one field is broken is in both tables: its other fields were read.
    """

    observations: DataFrame
    quarantine: DataFrame
    failed: dict[str, str] = field(default_factory=dict)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Stack tables by column name; a column or nested field one lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _month(spark: SparkSession, folder: str, style: str, infer: bool) -> DataFrame:
    reader = (
        spark.read.option("recursiveFileLookup", "true")
        .option("multiLine", style == PRETTY)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    )
    files = (reader if infer else reader.schema(WITH_CORRUPT)).json(folder)
    # The feed has a `_metadata` field of its own, which hides the file's.
    lineage = files.metadataColumn("_metadata").getField("file_path")
    return files.withColumn("source_file", lineage)


def read_weather(
    spark: SparkSession,
    settings: Settings,
    style: str = PRETTY,
    plain: bool = False,
    infer: bool = False,
    allow_partial: bool = False,
) -> WeatherInput:
    """Read the weather of the period, month by month.

    A month that cannot be opened is reported in ``failed``; it is an error
    unless ``allow_partial`` is set, and always when no month opens. A row that
    is not valid JSON, or has a field of another type, goes to ``quarantine``
    with its text. The explicit schema saves the pass over all files that
    ``infer`` needs; fields that inferred files lack are NULL.
    """
    frames, failed = [], {}
    for label, folder in month_folders(settings.weather_path, settings, plain):
        try:
            frames.append(_month(spark, folder, style, infer))
        except AnalysisException as problem:
            failed[label] = problem.getCondition() or str(problem)
    if not frames:
        raise FileNotFoundError(f"no weather could be read: {failed}")
    if failed and not allow_partial:
        raise FileNotFoundError(f"months that could not be read: {failed}")
    everything = union_by_name([*frames, spark.createDataFrame([], WITH_CORRUPT)])
    return WeatherInput(*split_corrupt(everything), failed)


def corrupt() -> Column:
    """Whether something of a row could not be read."""
    # A field that no one needs is not parsed, and then not found broken: the test names them all.
    fields = F.hash(*(F.col(f"`{f.name}`") for f in RAW_WEATHER.fields))
    return F.concat(F.col(CORRUPT_COLUMN), F.substring(fields.cast("string"), 1, 0)).isNotNull()


def readable() -> Column:
    """Whether anything of a row could be read."""
    return ~corrupt() | F.col("`_metadata`").isNotNull()


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of which anything could be read, and all rows of which something could not."""
    lineage = [c for c in ("source_file",) if c in rows.columns]
    return (
        rows.filter(readable()).drop(CORRUPT_COLUMN),
        rows.filter(corrupt()).select(*lineage, CORRUPT_COLUMN),
    )


def input_report(read: WeatherInput) -> DataFrame:
    """Rows kept, quarantined, and dropped because a needed field is missing."""
    seen = F.count(F.lit(1))
    kept = F.count_if(usable())
    nothing = F.lit(0).cast("long")
    parts = flatten(read.observations).agg(
        kept.alias("kept"), nothing.alias("quarantined"), (seen - kept).alias("dropped"),
    ).unionByName(read.quarantine.agg(
        nothing.alias("kept"), seen.alias("quarantined"), nothing.alias("dropped")))
    return parts.agg(*(F.sum(c).alias(c) for c in parts.columns))
