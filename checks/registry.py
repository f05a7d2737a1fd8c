"""Named checks: a Spark query and, where SQL can say it, the same result in DuckDB SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.fixtures import Inputs, duck_views

Query = Callable[[Inputs], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
VIEWS: dict[str, str] = duck_views()


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"Duplicate check {name}")
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return register


def view(name: str, sql: str) -> str:
    VIEWS[name] = sql
    return name


def _used(sql: str) -> list[str]:
    words = set(re.findall(r"\b[a-z_0-9]+\b", sql))
    return [name for name in VIEWS if name in words]


def with_views(sql: str) -> str:
    """Put the views a text needs in front of it, each after the views it needs itself."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for needed in _used(VIEWS[name]):
            if needed != name:
                add(needed)
        ordered.append(name)

    for name in _used(sql):
        add(name)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in ordered) + "\n" + sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: query(Inputs(spark, folder))

    return {name: bind(query) for name, query in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in SQL.items()}


def half_up(numerator: str, denominator: str, scale: int) -> str:
    """numerator / denominator as a double, rounded half away from zero at ``scale`` digits, in whole numbers."""
    n = f"(CAST({numerator} AS HUGEINT) * {10 ** scale})"
    d = f"CAST({denominator} AS HUGEINT)"
    return f"CAST(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})) AS DOUBLE) / {10 ** scale}"


def money(expression: str) -> str:
    return f"SUM(CAST({expression} AS DECIMAL(18,4)))"


def money_ratio(total: str, count: str, digits: int = 2) -> str:
    """total / count for a DECIMAL(38,4) total."""
    n = f"(CAST({total} * 10000 AS HUGEINT) * {10 ** digits})"
    d = f"(CAST({count} AS HUGEINT) * 10000)"
    return f"CAST(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})) AS DOUBLE) / {10 ** digits}"
