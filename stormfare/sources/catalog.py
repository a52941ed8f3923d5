"""Names for tables, views that outlive the session's frames, and SQL over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..schemas import Contract


def register(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Make each table a view under its name; a view is recomputed on every use."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run SQL over registered views and over tables passed by name."""
    return spark.sql(sql, **tables)


def columns_of(contract: Contract, extra: Mapping[str, str] | None = None) -> str:
    """A contract's columns as a table declares them, texts of a limited width as VARCHAR."""
    widths = dict(contract.max_length)
    declared = {
        name: f"VARCHAR({widths[name]})" if name in widths else kind.simpleString() for name, kind in contract.columns}
    return ", ".join(f"{name} {kind}" for name, kind in {**declared, **(extra or {})}.items())


def create_table(spark: SparkSession, name: str, contract: Contract, path: str,
                 partition_by: Mapping[str, str] | None = None) -> None:
    """Declare the Parquet folder of a contract in the catalog, whatever it was declared as before.

    The folder stays where it is, and stays when the table is dropped. Rows that
    are inserted by the name are held to the widths.
    """
    parts = partition_by or {}
    layout = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns_of(contract, parts)}) USING parquet {layout} LOCATION '{path}'")
    if parts:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def create_view(spark: SparkSession, name: str, sql: str) -> None:
    """A view that the catalog keeps; every session over the catalog reads it."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> None:
    """A catalog table dealt into so many buckets by its keys.

    Two tables with equal buckets of the keys they are joined on need no shuffle.
    A bucket is read by one task: for keys of which one holds much of the table
    a plain table, which adaptive execution can split, is better.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite").option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    )
