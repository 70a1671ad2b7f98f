"""Run registered queries next to their SQL in DuckDB and report where they differ.

    python tools/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from collections import Counter
from datetime import date, datetime

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


# How DuckDB names the types Spark returns here.
TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def plain(value):
    """One spelling for values both engines may hold in different types."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def as_counted(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(df, connection, sql: str) -> tuple[int, str | None]:
    """Row count of the Spark result, and a description of the first difference."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    expected = as_counted(names, answer.fetchall())
    rows = [tuple(r) for r in df.collect()]
    if sorted(names) != sorted(df.columns):
        return len(rows), f"columns {sorted(df.columns)} instead of {sorted(names)}"
    wanted = {d[0]: str(d[1]) for d in answer.description}
    types = {name: TYPE_NAMES.get(kind, kind) for name, kind in df.dtypes}
    if types != wanted:
        return len(rows), f"types {types} instead of {wanted}"
    found = as_counted(df.columns, rows)
    extra, missing = found - expected, expected - found
    if extra or missing:
        return len(rows), f"{extra.total()} extra {list(extra)[:2]}, {missing.total()} missing {list(missing)[:2]}"
    return len(rows), None


def main() -> int:
    from millrace.session import build_session
    from millrace.workload import REGISTRY

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--default-session", action="store_true", help="use Spark's own settings")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    if options.default_session:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session("local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle(options.sf)
    failed = []
    for name in options.names or REGISTRY:
        query = REGISTRY[name]
        started = time.time()
        try:
            rows, difference = compare(query.plan(spark, options.sf), connection, query.sql)
        except Exception as error:  # report and go on to the next query
            rows, difference = 0, f"{type(error).__name__}: {str(error)[:600]}"
        if difference or rows == 0:
            failed.append(name)
        outcome = "DIFF" if difference else "ok" if rows else "EMPTY"
        print(f"{outcome:5} {time.time() - started:6.2f}s {rows:8} {name} {difference or ''}", flush=True)
    print(f"{len(failed)} of {len(options.names or REGISTRY)} failed: {failed}")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
