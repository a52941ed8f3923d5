"""Run every registered query and its SQL side by side: ``python -m checks.compare``."""

from __future__ import annotations

import argparse
import glob
import math
import os
import time
from collections import Counter

import duckdb

from checks.oracle import ORACLE
from checks.registry import QUERIES


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    return v


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def differences(spark, db, name: str, folder: str) -> str | None:
    """Why the two results differ, or None."""
    df = QUERIES[name](spark, folder)
    mine = _rows(df.columns, df.collect())
    if name not in ORACLE:
        return None if mine else "no rows"
    cursor = db.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    theirs = _rows(columns, cursor.fetchall())
    if mine == theirs:
        return None
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"{sum(mine.values())} rows against {sum(theirs.values())}; "
        f"only ours {list(only_mine)[:2]}; only SQL {list(only_theirs)[:2]}"
    )


def main() -> None:
    from stormfare.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--folder", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    spark, db = local_session("compare", 8), database(args.folder)
    bad = 0
    for name in args.names or QUERIES:
        started = time.time()
        try:
            problem = differences(spark, db, name, args.folder)
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name:28s} "
              f"{time.time() - started:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(args.names or QUERIES)} differ")


if __name__ == "__main__":
    main()
