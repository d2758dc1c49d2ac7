"""Run queries next to their SQL and report differences: ``python -m workload.check DIR [name...]``."""

from __future__ import annotations

import decimal
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from workload.oracle import ORACLE
from workload.queries import QUERIES


def session(cpus: str | int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ratewright")
        .config("spark.sql.shuffle.partitions", str(cpus))
        # megabyte-sized test tables would be coalesced into one task
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def table(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """None if equal or without SQL counterpart, else the first difference."""
    df = QUERIES[name](spark, sf_dir)
    ours = table(df.columns, df.collect())
    if name not in ORACLE:
        return None if ours else "no rows"
    cursor = connection.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    theirs = table(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    types = [{type(v) for v in column if v is not None} for column in zip(*ours)] if ours else []
    expected = [{type(v) for v in column if v is not None} for column in zip(*theirs)] if theirs else []
    if types != expected:
        return f"types {types} against {expected}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> int:
    spark, connection = session(), connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.perf_counter()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        kind = "sql" if name in ORACLE else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {kind:4} {time.perf_counter() - start:6.1f}s {name} {problem or ''}", flush=True)
        failed += bool(problem)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
