"""Parquet tables: contract, idempotent overwrite and write metrics."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..schemas import Contract
from ..session import delete, swap


@dataclass(frozen=True)
class WriteReport:
    """What one write did; the counts come from the write itself."""

    path: str
    rows: int
    seconds: float
    broken: dict[str, int]
    #: Failures of the single-row data tests that the write carried, zeros included.
    tested: dict[str, int] = field(default_factory=dict)
    #: Folders that got rows, where the write replaces only these.
    partitions: frozenset[str] = field(default=frozenset())

    @property
    def rows_per_second(self) -> float:
        return self.rows / self.seconds if self.seconds > 0 else 0.0


def write_table(
    df: DataFrame,
    path: str,
    contract: Contract | None = None,
    partition_by: tuple[str, ...] = (),
    gather: bool = False,
    sort_by: tuple[str, ...] = (),
    only_these_partitions: bool = False,
    strict: bool = False,
    derived: dict[str, Column] | None = None,
    counted: tuple[Column, ...] = (),
    tested: Mapping[str, Column] | None = None,
) -> WriteReport:
    """Overwrite a table, so that running again gives the same table.

    With ``only_these_partitions`` the other partitions stay: the reload of a
    period. Rows breaking the contract are counted by the write and returned;
    with ``strict`` the first one fails the write. A full overwrite is written
    beside the table and takes its place once all rows are there, a reload of
    some partitions replaces them only then: a write that fails leaves the table
    as it was, and readers see the old one until the new one is whole.

    ``derived`` columns, which the contract does not know, name folders.
    ``counted`` aggregates are reported with the broken promises where they are not 0.
    ``tested`` conditions of failing rows are counted by the write as well, so that
    data tests need not read the table again.

    ``gather`` shuffles the rows of each partition folder together, which is
    needed when every task has rows of many folders and would leave a small file
    in each; a folder much larger than the others is split again. Without it the
    write moves no data. ``sort_by`` orders the rows inside each file, which
    gives readers narrow min/max ranges to skip by.
    """
    table = df
    if contract:
        table = contract.enforce(df) if strict else contract.conform(df)
    if derived:
        table = table.withColumns(derived)
    checks = [*(contract.violations() if contract else []), *counted]
    tests = {f"_test_{i}": name for i, name in enumerate(tested or {})}
    checks += [F.count_if(tested[name]).alias(alias) for alias, name in tests.items()]
    if only_these_partitions:
        folder = F.concat_ws("/", *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in partition_by))
        checks.append(F.collect_set(folder).alias("_folders"))  # as many as the write has folders
    metrics = Observation()
    table = table.observe(metrics, F.count(F.lit(1)).alias("rows"), *checks)
    if gather:
        table = table.hint("rebalance", *partition_by)
    if sort_by:
        table = table.sortWithinPartitions(*partition_by, *sort_by)
    started = time.monotonic()
    if only_these_partitions:
        (
            table.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(path)
        )
    else:
        spark, beside = df.sparkSession, f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
        try:
            table.write.partitionBy(*partition_by).parquet(beside)
            swap(spark, beside, path)
        finally:
            delete(spark, beside)
    seconds = time.monotonic() - started
    found = dict(metrics.get)
    rows, folders = found.pop("rows"), frozenset(found.pop("_folders", ()))
    failures = {name: found.pop(alias) for alias, name in tests.items()}
    return WriteReport(path, rows, seconds, {k: v for k, v in found.items() if v}, failures, folders)
