"""Integrity manifest of Parquet files, its comparison, and the ingestion report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .files import by_schema, listing, parquet_reader, with_schemas


def row_fingerprint(*columns: str) -> list[Column]:
    """Aggregates that identify a set of rows in any order and any file layout.

    Every value is written with its length and a NULL with a mark of its own, so
    no two different rows have one text. The 128 bits of each row's MD5 are
    added up in two halves.
    """
    def marked(name: str) -> Column:
        value = F.col(f"`{name}`").cast("string")
        known = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        return F.coalesce(known, F.lit("-"))

    digest = F.md5(F.concat_ws("", *map(marked, columns)))
    halves = [F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    added = [F.coalesce(F.sum(h), F.lit(0)).cast("decimal(38,0)").cast("string") for h in halves]
    return [F.count(F.lit(1)).alias("rows"), F.concat_ws("-", *added).alias("digest")]


STAMP = ["file", "length", "modified"]


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Name below ``path``, size, rows and digest of all columns of every file, whatever its size.

    A file that cannot be read has no digest.
    """
    return update_manifest(spark, path).drop("modified", "fresh")


def update_manifest(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """The manifest with the time each file was changed, from ``known`` where a file is as it was.

    Only files that the former manifest lacks, or has with another size or time,
    are opened; these are ``fresh``. Data files are written once under a name of
    their own, so a reload is seen; a file overwritten in place within the same
    millisecond to the same size is not.
    """
    root = path.rstrip("/")
    name = F.substring_index("path", root.split(":")[-1].lstrip("/") + "/", -1)
    now = listing(spark, root).select(name.alias("file"), "path", "length", "modified")
    kept = None
    if known is not None:
        kept = known.select(*STAMP, "rows", "digest").join(now.select(*STAMP), STAMP, "left_semi")
        now = now.join(known.select(*STAMP), STAMP, "left_anti")
    files = with_schemas(spark, now)
    readable = spark.createDataFrame([(f.path, f.schema is not None) for f in files], "path string, readable boolean")
    digests = [spark.createDataFrame([], "path string, rows long, digest string")]
    for paths in by_schema(files).values():
        read = parquet_reader(spark).parquet(*paths)
        at = read.metadataColumn("_metadata").getField("file_path")
        # Columns in order of name: the order within a file does not matter.
        digests.append(read.withColumn("_path", at).groupBy(F.col("_path").alias("path")).agg(
            *row_fingerprint(*sorted(read.columns))))
    found = now.join(readable, "path").join(reduce(DataFrame.unionByName, digests), "path", "left")
    fresh = found.select(
        *STAMP, F.when(F.col("readable"), F.coalesce("rows", F.lit(0))).alias("rows"),
        F.when(F.col("readable"), F.coalesce("digest", F.lit("0-0"))).alias("digest"), F.lit(True).alias("fresh"))
    return fresh if kept is None else fresh.unionByName(kept.withColumn("fresh", F.lit(False)))


def _added_digests() -> Column:
    half = [F.sum(F.split_part("digest", F.lit("-"), F.lit(i)).cast("decimal(38,0)")) for i in (1, 2)]
    return F.when(F.count_if(F.col("digest").isNull()) == 0, F.concat_ws("-", *[h.cast("string") for h in half]))


def digest_tree(manifest: DataFrame) -> DataFrame:
    """Size, rows and digest of every folder at every level, the whole table (an empty name, level 0) included."""
    parts = F.split("file", "/")
    levels = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.struct(
        n.alias("level"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("folder")))
    return manifest.select("length", "rows", "digest", F.explode(levels).alias("at")).groupBy(
        "at.level", "at.folder").agg(
        F.sum("length").alias("length"), F.sum("rows").alias("rows"), _added_digests().alias("digest"))


def differing_folders(before: DataFrame, after: DataFrame, levels: int) -> DataFrame:
    """Folders of two trees whose contents differ, level by level below folders that differ; equal ones are not entered."""
    tree = before.select("level", "folder", F.struct("rows", "digest").alias("old")).join(
        after.select("level", "folder", F.struct("rows", "digest").alias("new")), ["level", "folder"], "full_outer")
    unlike = tree.filter(~F.col("old").eqNullSafe(F.col("new")) | F.col("old.digest").isNull())
    found = unlike.filter("level = 0")
    open_ = found
    for level in range(1, levels + 1):
        below = unlike.filter(F.col("level") == level).withColumn(
            "_in", F.regexp_replace("folder", "/?[^/]*$", ""))
        open_ = below.join(open_.select(F.col("folder").alias("_in")), "_in", "left_semi").drop("_in")
        found = found.unionByName(open_)
    return found.select("level", "folder")


def folder_manifest(manifest: DataFrame) -> DataFrame:
    """The manifest by folder: digests add up, so a reload into other files compares as equal."""
    folder = F.regexp_replace("file", "/?[^/]*$", "")
    return manifest.groupBy(folder.alias("file")).agg(
        F.sum("length").alias("length"), F.sum("rows").alias("rows"), _added_digests().alias("digest"))


def compare_manifests(before: DataFrame, after: DataFrame) -> DataFrame:
    """State of each file or folder: same, changed, missing, new, or unverified without a digest."""

    def side(df: DataFrame, prefix: str) -> DataFrame:
        kept = ("length", "rows", "digest")
        return df.select("file", F.lit(True).alias(f"{prefix}_there"),
                         *(F.col(c).alias(f"{prefix}_{c}") for c in kept))

    both = side(before, "before").join(side(after, "after"), "file", "full_outer")
    equal = (F.col("before_rows") == F.col("after_rows")) & (F.col("before_digest") == F.col("after_digest"))
    state = (
        F.when(F.col("after_there").isNull(), "missing")
        .when(F.col("before_there").isNull(), "new")
        .when(F.col("before_digest").isNull() | F.col("after_digest").isNull(), "unverified")
        .when(equal, "same")
        .otherwise("changed")
    )
    return both.withColumn("state", state).drop("before_there", "after_there")


def size_differences(manifest: DataFrame, listed: DataFrame, path: str) -> DataFrame:
    """Files whose size is not that of the manifest, or which only one of both has."""
    root = path.rstrip("/").split(":")[-1].lstrip("/")
    name = F.substring_index("path", root + "/", -1)
    now = listed.select(name.alias("file"), F.col("length").alias("length_now"))
    both = manifest.select("file", "length").join(now, "file", "full_outer")
    return both.filter(~F.col("length").eqNullSafe(F.col("length_now")))


def month_sizes(manifest: DataFrame) -> DataFrame:
    """Megabytes per month, from the year and month folders of the file names."""
    number = r"(?:year=)?(\d{4})/(?:month=)?(\d{1,2})(?:/|$)"
    year, month_number = (F.regexp_extract("file", number, i) for i in (1, 2))
    month = F.concat_ws("-", year, F.lpad(month_number, 2, "0"))
    return manifest.groupBy(month.alias("month")).agg(
        F.round(F.sum("length") / F.lit(1024.0 * 1024.0), 1).alias("size_mb")
    )


def ingest_summary(months: DataFrame) -> DataFrame:
    """Succeeded and failed months and the total size of the succeeded ones."""
    good = F.col("status") == "SUCCESS"
    columns = [
        F.count(F.lit(1)).alias("months"),
        F.count_if(good).alias("succeeded"),
        F.count_if(~good).alias("failed"),
        F.coalesce(F.sum(F.when(good, F.col("rows"))), F.lit(0)).alias("rows"),
    ]
    if "size_mb" in months.columns:
        size = F.sum(F.when(good, F.col("size_mb")))
        columns.append(F.round(F.coalesce(size, F.lit(0.0)), 1).alias("size_mb"))
    return months.agg(*columns)
