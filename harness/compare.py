"""Run registered queries on Spark and DuckDB and compare the rows.

    python -m harness.compare <sf_dir> [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def rows_of(names: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(tuple(_cell(row[at]) for at in order) for row in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> list[str]:
    """Differences between the two engines; empty if they agree."""
    from harness.oracle import ORACLES
    from harness.queries import QUERIES

    found = QUERIES[name](spark, sf_dir)
    expected = con.execute(ORACLES[name])
    names = [column[0] for column in expected.description]
    if sorted(found.columns) != sorted(names):
        return [f"columns {sorted(found.columns)} != {sorted(names)}"]
    left = rows_of(found.columns, [tuple(row) for row in found.collect()])
    right = rows_of(names, expected.fetchall())
    problems = [] if len(left) == len(right) else [f"{len(left)} rows != {len(right)}"]
    if left != right:
        extra, missing = sorted(set(left) - set(right)), sorted(set(right) - set(left))
        problems.append(f"{len(extra)} rows only in Spark, e.g. {extra[:2]}")
        problems.append(f"{len(missing)} rows only in DuckDB, e.g. {missing[:2]}")
    return problems


def main() -> int:
    sf_dir, *only = sys.argv[1:]
    from harness.queries import QUERIES
    from harness.session import local_session

    spark, con, bad = local_session("compare"), duck(sf_dir), 0
    for name in only or QUERIES:
        start = time.time()
        try:
            problems = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:500]}"]
        bad += bool(problems)
        print("FAIL" if problems else "ok", name, f"{time.time() - start:.1f}s", *problems, sep="  ", flush=True)
    print(f"{bad} of {len(only or QUERIES)} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
