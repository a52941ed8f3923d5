"""Files below a folder, one by one: what is there, and which columns each file has."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import written

#: Footers read at a time. Each is a small task of its own.
FOOTERS_AT_ONCE = 16
#: Files up to this size are read whole in tasks for the sake of their footers.
SMALL_BYTES = 16 << 20
#: Under this key Spark leaves a table's schema in a file; fixed value.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
FOOTER_ERROR = "CANNOT_READ_FILE_FOOTER"


@dataclass(frozen=True)
class ParquetFile:
    """A listed file. ``schema`` is missing where the footer cannot be read."""

    path: str
    length: int
    schema: T.StructType | None


def parquet_reader(spark: SparkSession):
    return spark.read.option("recursiveFileLookup", "true")


def _schema(spark: SparkSession, path: str) -> T.StructType | None:
    try:
        return parquet_reader(spark).parquet(path).schema
    except (PySparkException, Py4JJavaError) as problem:
        # Any other failure, such as a lost executor, says nothing about the file.
        if FOOTER_ERROR in str(problem) or "UNABLE_TO_INFER_SCHEMA" in str(problem):
            return None
        raise


def listing(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """Path, length and time of the last change of every file; no file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(folder)
    )
    path = files.metadataColumn("_metadata").getField("file_path")
    return files.select(path.alias("path"), "length", F.col("modificationTime").alias("modified"))


def list_parquet(spark: SparkSession, folder: str) -> list[ParquetFile]:
    """Every file with its own schema; an absent folder is an ``AnalysisException``."""
    return with_schemas(spark, listing(spark, folder))


def _plain_kind(column) -> str | None:
    """The type that a flat column without anything unusual has in a table."""
    logical = column.logical_type.type
    if column.max_repetition_level or column.path != column.name:
        return None
    if logical == "NONE":
        return {"BOOLEAN": "boolean", "INT32": "integer", "INT64": "long", "FLOAT": "float", "DOUBLE": "double"}.get(
            column.physical_type)
    if logical == "STRING":
        return "string"
    if logical == "DATE":
        return "date"
    if logical == "TIMESTAMP" and column.physical_type == "INT64":
        told = json.loads(column.logical_type.to_json())
        if told["timeUnit"] in ("microseconds", "milliseconds"):
            return "timestamp" if told["isAdjustedToUTC"] else "timestamp_ntz"
    return None


def footer_schema(content: bytes) -> str | None:
    """The schema in a file's footer as JSON, where it is Spark's own or of plain columns; else not told."""
    try:
        footer = pq.read_metadata(pa.BufferReader(content))
    except (pa.ArrowException, OSError):
        return None
    own = (footer.metadata or {}).get(SPARK_SCHEMA)
    if own is not None:
        return own.decode()
    columns = [footer.schema.column(i) for i in range(footer.num_columns)]
    kinds = [_plain_kind(c) for c in columns]
    if None in kinds:
        return None
    return json.dumps({"type": "struct", "fields": [
        {"name": c.name, "type": k, "nullable": True, "metadata": {}} for c, k in zip(columns, kinds)]})


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        told = [footer_schema(c.as_buffer()) for c in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(told, pa.string())], names=["path", "told"])


def _told_schemas(spark: SparkSession, paths: list[str]) -> dict[str, T.StructType]:
    """Schemas of small files whose footers tell it, all read in one job; the driver gets each schema once."""
    if not paths:
        return {}
    files = spark.read.format("binaryFile").load(paths)
    path = files.metadataColumn("_metadata").getField("file_path")
    told = files.select(path.alias("path"), "content").mapInArrow(_footers, "path string, told string")
    marked = told.filter("told IS NOT NULL").withColumn("mark", F.xxhash64("told"))
    found = written(marked, "footers")
    schemas = {r.mark: _as_read(T.StructType.fromJson(json.loads(r.told)))
               for r in found.select("mark", "told").distinct().collect()}
    return {r.path: schemas[r.mark] for r in found.select("path", "mark").collect()}


def _as_read(schema: T.StructType) -> T.StructType:
    """Columns without the notes and duties of the table they were written from."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.toNullable().fields])


def with_schemas(spark: SparkSession, files: DataFrame) -> list[ParquetFile]:
    """Listed files with their own schemas.

    Files of up to ``SMALL_BYTES`` are opened in tasks, many to a task. A larger
    file, or one whose footer does not tell its schema plainly, is asked for it
    by a small job of its own, which reads the footer alone.
    """
    rows = files.select("path", "length").collect()  # one row per file, as any reader's driver holds
    told = _told_schemas(spark, [r.path for r in rows if r.length <= SMALL_BYTES])
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        others = [r.path for r in rows if r.path not in told]
        schemas = {**told, **dict(zip(others, pool.map(lambda path: _schema(spark, path), others)))}
    return [ParquetFile(r.path, r.length, schemas[r.path]) for r in rows]


def by_schema(files: Iterable[ParquetFile]) -> dict[tuple, list[str]]:
    """Paths of the readable files, those of one schema together."""
    groups: dict[tuple, list[str]] = {}
    for file in files:
        if file.schema is not None:
            key = tuple((f.name, f.dataType.simpleString()) for f in file.schema.fields)
            groups.setdefault(key, []).append(file.path)
    return groups


def problem_of(error: AnalysisException) -> str:
    return error.getCondition() or "UNREADABLE"
