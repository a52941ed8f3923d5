"""Raw trip files: reading and checking, file by file."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import fixed_values as fv
from ..config import Settings
from ..schemas import RAW_TRIPS
from .files import ParquetFile, by_schema, list_parquet, parquet_reader, problem_of
from .layout import month_folders


def conform_raw(df: DataFrame) -> DataFrame:
    """Only the columns the stages use, in their contract types; an absent one is NULL.

    A column that already has its type is left alone, so its filters still
    reach the scan.
    """
    columns = [
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in RAW_TRIPS.fields
    ]
    extra = [F.col("source_file")] if "source_file" in df.columns else []
    return df.select(*columns, *extra)


def missing_columns(df: DataFrame | T.StructType) -> list[str]:
    """Required columns the table lacks."""
    names = df.names if isinstance(df, T.StructType) else df.columns
    return sorted(set(fv.REQUIRED_TRIP_COLUMNS) - set(names))


def _kind(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "number"
    return "time" if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else kind.simpleString()


def schema_problem(schema: T.StructType | None) -> str | None:
    """What keeps a file of this schema from being read as trips."""
    if schema is None:
        return "unreadable"
    absent = missing_columns(schema)
    found = {f.name: f.dataType for f in schema.fields}
    # Widths may differ from month to month, numbers and text may not.
    wrong = [
        f"{f.name} {found[f.name].simpleString()}" for f in RAW_TRIPS.fields
        if f.name in found and _kind(found[f.name]) != _kind(f.dataType)
    ]
    parts = [f"{label}: {', '.join(x)}" for label, x in (("missing columns", absent), ("wrong types", wrong)) if x]
    return "; ".join(parts) or None


@dataclass(frozen=True)
class MonthFiles:
    """A month's files, or why its folder cannot be opened."""

    month: str
    folder: str
    files: tuple[ParquetFile, ...]
    error: str | None = None


def month_files(spark: SparkSession, settings: Settings, plain: bool = False) -> list[MonthFiles]:
    found = []
    for label, folder in month_folders(settings.trip_path, settings, plain):
        try:
            files = tuple(list_parquet(spark, folder))
            found.append(MonthFiles(label, folder, files, None if files else "no files"))
        except AnalysisException as problem:
            found.append(MonthFiles(label, folder, (), problem_of(problem)))
    return found


def read_trips(spark: SparkSession, settings: Settings, plain: bool = False) -> DataFrame:
    """All trip files of the period as one table, with the file each row is from.

    Files are read in groups of one schema, and each group is cast, so months
    may disagree on types. A file that cannot be read as trips is an error that
    names it.
    """
    months = month_files(spark, settings, plain)
    bad = [f"{m.folder}: {m.error}" for m in months if m.error]
    bad += [f"{f.path}: {p}" for m in months for f in m.files if (p := schema_problem(f.schema))]
    if bad:
        raise ValueError("trip files that cannot be read: " + "; ".join(bad))
    frames = []
    for paths in by_schema(f for m in months for f in m.files).values():
        files = parquet_reader(spark).parquet(*paths)
        lineage = files.metadataColumn("_metadata").getField("file_path")
        frames.append(conform_raw(files.withColumn("source_file", lineage)))
    return reduce(DataFrame.unionByName, frames)


def _rows_per_file(spark: SparkSession, files: list[ParquetFile]) -> DataFrame:
    """Rows of each file that has any; no column is read."""
    counts = [spark.createDataFrame([], "path string, rows long")]
    for paths in by_schema(files).values():
        read = parquet_reader(spark).option("ignoreCorruptFiles", "true").parquet(*paths)
        path = read.metadataColumn("_metadata").getField("file_path")
        counts.append(read.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("rows")))
    return reduce(DataFrame.unionByName, counts)


def validate_files(spark: SparkSession, settings: Settings, plain: bool = False) -> DataFrame:
    """One row per file, and one per month that has none: rows, what is wrong, SUCCESS or FAILED.

    ``file`` is the path below the trip folder.
    """
    months = month_files(spark, settings, plain)
    listed = [(m.month, f.path, schema_problem(f.schema)) for m in months for f in m.files]
    listed += [(m.month, None, m.error) for m in months if m.error]
    files = spark.createDataFrame(listed, "month string, path string, problem string")
    counted = files.join(_rows_per_file(spark, [f for m in months for f in m.files]), "path", "left")
    rows = F.coalesce("rows", F.lit(0))
    empty = F.when(F.col("path").isNotNull() & (rows == 0), "empty")
    root = settings.trip_path.rstrip("/").split(":")[-1].lstrip("/")
    below = F.substring_index("path", f"{root}/", -1)
    error = F.coalesce("problem", empty)
    return counted.select(
        "month", below.alias("file"), rows.alias("rows"), error.alias("error"),
        F.when(error.isNull(), "SUCCESS").otherwise("FAILED").alias("status"),
    )


def validate_months(spark: SparkSession, settings: Settings, plain: bool = False) -> DataFrame:
    """One row per month: rows, files, what is wrong, and SUCCESS or FAILED.

    A month fails when it cannot be opened, has no file, or has a file that
    lacks a required column, has one of another kind, is empty or cannot be
    read. The error names each such file; its rows do not count.
    """
    checked = validate_files(spark, settings, plain)
    named = F.concat_ws(": ", "file", "error")
    return checked.groupBy("month").agg(
        F.sum(F.when(F.col("error").isNull(), F.col("rows")).otherwise(0)).alias("rows"),
        F.count("file").alias("files"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("error").isNotNull(), named))), "; ").alias("_error"),
    ).select(
        "month", "rows", "files", F.nullif("_error", F.lit("")).alias("error"),
        F.when(F.col("_error") == "", "SUCCESS").otherwise("FAILED").alias("status"),
    )


def file_row_counts(trips: DataFrame) -> DataFrame:
    """Rows per source file of a table read by :func:`read_trips`."""
    return trips.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
