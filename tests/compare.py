"""Order-insensitive comparison of Spark rows with DuckDB rows."""

from __future__ import annotations

import datetime
import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb

TEST_DATA = os.environ.get("OUTLAY_TESTDATA", "/root/testdata")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"create view {name} as select * from read_parquet('{files}')")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return ("datetime", value.isoformat())
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    return (type(value).__name__, value)


def bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(spark_rows, spark_names, sql_rows, sql_names) -> str | None:
    if sorted(spark_names) != sorted(sql_names):
        return f"columns {sorted(spark_names)} != {sorted(sql_names)}"
    left, right = bag(spark_names, spark_rows), bag(sql_names, sql_rows)
    if left == right:
        return None
    return (
        f"{sum(left.values())} vs {sum(right.values())} rows; only Spark {list((left - right).items())[:2]}; "
        f"only SQL {list((right - left).items())[:2]}"
    )
