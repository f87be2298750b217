"""Run queries in Spark and their SQL in DuckDB, and compare the results.

    python -m parity.check /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from courierlake.session import build_session
from parity.oracle import oracle_sql
from parity.queries import queries


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _sort_key(row: tuple) -> tuple:
    def part(value):
        if value is None:
            return (0, "")
        if isinstance(value, float):
            return (1, f"{value:.6g}")
        return (1, str(value))

    return tuple(part(value) for value in row)


def _same(left, right) -> bool:
    if isinstance(left, float) and isinstance(right, float):
        return math.isclose(left, right, rel_tol=1e-9, abs_tol=1e-9)
    return type(left) is type(right) and left == right


def compare(ours: list[dict], theirs: list[dict]) -> str:
    """'' if both hold the same rows, else what differs."""
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    if not ours:
        return ""
    names = sorted(ours[0])
    if names != sorted(theirs[0]):
        return f"columns {names} != {sorted(theirs[0])}"
    left = sorted((tuple(row[n] for n in names) for row in ours), key=_sort_key)
    right = sorted((tuple(row[n] for n in names) for row in theirs), key=_sort_key)
    differing = [
        (dict(zip(names, a)), dict(zip(names, b)))
        for a, b in zip(left, right)
        if not all(map(_same, a, b))
    ]
    if differing:
        return f"{len(differing)} rows differ, first {differing[0]}"
    # Results that are equal up to the last bits of a double only.
    inexact = sum(a != b for a, b in zip(left, right))
    return f"~{inexact}" if inexact else ""


def run(spark: SparkSession, folder: str, names: list[str]) -> int:
    connection, sql, failures = connect(folder), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            ours = [row.asDict() for row in query(spark, folder).collect()]
            result = "no SQL"
            if name in sql:
                cursor = connection.execute(sql[name])
                columns = [column[0] for column in cursor.description]
                theirs = [dict(zip(columns, row)) for row in cursor.fetchall()]
                result = compare(ours, theirs)
            rows = len(ours)
        except Exception as error:  # report and go on with the next query
            result, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        passed = result in ("", "no SQL") or result.startswith("~")
        failures += not passed
        print(
            f"{'ok  ' if passed else 'FAIL'} {name} rows={rows} {time.time() - started:.2f}s {result}",
            flush=True,
        )
    print(f"{failures} failures")
    return failures


def main(folder: str, *names: str) -> int:
    spark = build_session(
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="courierlake-check-"),
        }
    )
    spark.sparkContext.setLogLevel("OFF")
    return run(spark, folder, list(names))


if __name__ == "__main__":
    sys.exit(min(main(*sys.argv[1:]), 1))
