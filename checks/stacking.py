"""Several tables as one result: (table_name, row_key, digest), the same in Spark and in DuckDB."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.contracts import ServingTable, serving_table

SCALE = 10_000  # doubles are compared in whole ten-thousandths


def _spark_text(name: str, kind: str):
    column = F.col(name)
    if kind in ("double", "float"):
        column = F.round(column * SCALE).cast("bigint")
    if kind.startswith("timestamp"):
        return F.coalesce(F.date_format(column, "yyyy-MM-dd HH:mm:ss"), F.lit("~"))
    if kind.startswith("array"):
        return F.coalesce(F.array_join(column, ","), F.lit("~"))
    return F.coalesce(column.cast("string"), F.lit("~"))


def _duck_text(name: str, kind: str) -> str:
    if kind in ("double", "float"):
        name = f"CAST(round({name} * {SCALE}) AS BIGINT)"
    if kind.startswith("timestamp"):
        return f"coalesce(strftime({name}, '%Y-%m-%d %H:%M:%S'), '~')"
    if kind.startswith("array"):
        return f"coalesce(array_to_string({name}, ','), '~')"
    return f"coalesce(CAST({name} AS VARCHAR), '~')"


Kinds = Mapping[str, str]


def kinds_of(table: ServingTable) -> dict[str, str]:
    return {field.name: field.dataType.simpleString() for field in table.schema}


def rows(df: DataFrame, name: str, key: str, kinds: Kinds) -> DataFrame:
    digest = F.md5(F.concat_ws("|", *[_spark_text(c, k) for c, k in kinds.items()]))
    return df.select(F.lit(name).alias("table_name"), _spark_text(key, kinds[key]).alias("row_key"), digest.alias("digest"))


def rows_sql(source: str, name: str, key: str, kinds: Kinds) -> str:
    parts = ", ".join(_duck_text(c, k) for c, k in kinds.items())
    return f"SELECT '{name}' AS table_name, {_duck_text(key, kinds[key])} AS row_key, md5(concat_ws('|', {parts})) AS digest FROM {source}"


def serving(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Serving tables, by their contracts."""
    tables = {name: serving_table(name) for name in frames}
    return reduce(DataFrame.unionByName, [rows(frames[name], name, t.key[0], kinds_of(t)) for name, t in tables.items()])


def serving_sql(sources: Mapping[str, str]) -> str:
    tables = {name: serving_table(name) for name in sources}
    return " UNION ALL ".join(rows_sql(sources[name], name, t.key[0], kinds_of(t)) for name, t in tables.items())
