"""Overwrite of a warehouse table over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    table: str
    connections: int = 8
    batch_rows: int = 1000
    properties: dict[str, str] = field(default_factory=dict)


def write_jdbc(df: DataFrame, target: JdbcTarget) -> None:
    """Replace the rows of a table with the rows of ``df``.

    The table is emptied, not dropped, so its keys, constraints and indexes
    stay. Rows are spread over ``connections`` tasks, one connection each: the
    shuffle keeps the work before it parallel, which merging partitions would not.
    """
    (
        df.repartition(target.connections)
        .write.mode("overwrite")
        .option("truncate", True)
        .option("batchsize", target.batch_rows)
        .jdbc(target.url, target.table, properties=dict(target.properties))
    )
