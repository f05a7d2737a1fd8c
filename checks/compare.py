"""Run checks on Spark and on DuckDB and compare the results."""

from __future__ import annotations

import math
import sys
import time
from datetime import datetime
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark_df, connection, sql: str) -> str | None:
    """None if equal, else what differs. Values must be equal exactly, types too (int vs float)."""
    result = connection.sql(sql)
    if sorted(spark_df.columns) != sorted(result.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(result.columns)}"
    left, right = rows_of(spark_df.columns, spark_df.collect()), rows_of(result.columns, result.fetchall())
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for a, b in zip(left, right):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None


def main(folder: str, names: list[str]) -> int:
    from checks import catalog

    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config(
        "spark.sql.shuffle.partitions", "8"
    ).config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, failed = duck(folder), catalog.oracle_sql(), 0
    for name, query in catalog.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, folder)
            verdict = compare(df, connection, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        if verdict and not verdict.startswith("rows only"):
            failed += 1
        print(f"{time.time() - started:6.2f}s {name}: {verdict or 'equal'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
