"""Serving: Gold snapshots projected to their contract and loaded from the executors.

A target replaces several tables by one call. ``SnapshotTarget`` and ``JdbcTarget`` make the new rows of all of them visible
in one step; ``FileTarget`` switches one table after the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluicebox.contracts import BATCH_GOLD, SERVING_TABLES, ServingTable, serving_table
from sluicebox.functions.numbers import nan_to_null
from sluicebox.sources.snapshots import Snapshots, View
from sluicebox.sources.storage import DEFAULT_FORMAT, path_exists, read_table, write_counted

CHUNK_ROWS = 1000


def serving_rows(df: DataFrame, table: ServingTable) -> DataFrame:
    """Contract columns, in order, with contract types; NaN becomes NULL."""
    typed = [F.col(field.name).cast(field.dataType).alias(field.name) for field in table.schema]
    return nan_to_null(df.select(*typed))


@dataclass(frozen=True)
class FileTarget:
    """Serving tables as stored tables under one folder."""

    root: str
    fmt: str = DEFAULT_FORMAT

    def replace(self, rows: Mapping[str, DataFrame]) -> dict[str, int]:
        return {name: write_counted(df, f"{self.root}/{name}", "overwrite", self.fmt)["rows"] for name, df in rows.items()}


@dataclass(frozen=True)
class SnapshotTarget:
    """Serving tables as versions under one folder: readers take a ``View`` and see all tables of one load."""

    store: Snapshots

    def replace(self, rows: Mapping[str, DataFrame]) -> dict[str, int]:
        return self.store.commit(rows)

    def view(self) -> View:
        return self.store.current()


def swap_tables(connection, swaps: Mapping[str, tuple[str, list[str]]]) -> None:
    """Fill each table anew from its side table, all in one transaction: (table -> (side table, columns)).

    The rows stay inside the database; the tables keep their keys and indexes, and a broken key undoes everything.
    """
    connection.setAutoCommit(False)
    try:
        statement = connection.createStatement()
        for table, (side, columns) in swaps.items():
            names = ", ".join(columns)
            statement.executeUpdate(f"DELETE FROM {table}")
            statement.executeUpdate(f"INSERT INTO {table} ({names}) SELECT {names} FROM {side}")
        connection.commit()
    except BaseException:
        connection.rollback()
        raise


@dataclass(frozen=True)
class JdbcTarget:
    """Serving tables in a database. Executors fill side tables in chunks; one transaction then moves all rows over.

    Readers see the old rows of all tables until that transaction ends. The tables must exist, with their keys.
    """

    url: str
    properties: dict[str, str]
    connections: int = 16

    def _fill(self, df: DataFrame, side: str) -> int:
        """Rows are dealt to as many tasks as there may be connections; their count comes from the write itself."""
        seen = Observation()
        dealt = df.observe(seen, F.count(F.lit(1)).alias("rows")).repartition(self.connections)
        dealt.write.mode("overwrite").option("batchsize", CHUNK_ROWS).jdbc(self.url, side, properties=self.properties)
        return int(seen.get["rows"])

    def _connect(self, spark: SparkSession):
        properties = spark._jvm.java.util.Properties()
        for key, value in self.properties.items():
            properties.setProperty(key, value)
        if "driver" in self.properties:
            spark._jvm.java.lang.Class.forName(self.properties["driver"])
        return spark._jvm.java.sql.DriverManager.getConnection(self.url, properties)

    def replace(self, rows: Mapping[str, DataFrame]) -> dict[str, int]:
        run = uuid.uuid4().hex[:12]
        swaps = {name: (f"{name}_{run}", df.columns) for name, df in rows.items()}
        counts, spark = {}, next(iter(rows.values())).sparkSession
        try:
            for name, df in rows.items():
                counts[name] = self._fill(df, swaps[name][0])
            connection = self._connect(spark)
            try:
                swap_tables(connection, swaps)
            finally:
                connection.close()
        finally:
            self._drop(spark, [side for name, (side, _) in swaps.items() if name in counts])
        return counts

    def _drop(self, spark: SparkSession, sides: Iterable[str]) -> None:
        connection = self._connect(spark)
        try:
            for side in sides:
                connection.createStatement().executeUpdate(f"DROP TABLE {side}")
        finally:
            connection.close()


Target = FileTarget | SnapshotTarget | JdbcTarget


@dataclass(frozen=True)
class ServingLoad:
    table: str
    rows: int


def replace_serving_tables(gold: Mapping[str, DataFrame], target: Target) -> list[ServingLoad]:
    """Load the given tables by one call of the target."""
    counts = target.replace({name: serving_rows(df, serving_table(name)) for name, df in gold.items()})
    return [ServingLoad(name, counts[name]) for name in gold]


def replace_serving_table(gold: DataFrame, name: str, target: Target) -> ServingLoad:
    return replace_serving_tables({name: gold}, target)[0]


def load_serving(
    spark: SparkSession,
    gold_root: str,
    target: Target,
    tables: Iterable[str] | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> list[ServingLoad]:
    """Replace the chosen serving tables, by default the five batch ones, together where the target can."""
    chosen = _known(tables)
    missing = [name for name in chosen if not path_exists(spark, f"{gold_root}/{name}")]
    if missing:
        raise FileNotFoundError(f"Gold tables are missing: {', '.join(missing)}")
    return replace_serving_tables({name: read_table(spark, f"{gold_root}/{name}", fmt) for name in chosen}, target)


def load_serving_view(gold: View, target: Target, tables: Iterable[str] | None = None) -> list[ServingLoad]:
    """The same from one version of Gold, so that the served tables belong together."""
    chosen = _known(tables)
    missing = [name for name in chosen if name not in gold]
    if missing:
        raise FileNotFoundError(f"Gold tables are missing: {', '.join(missing)}")
    return replace_serving_tables(gold.read_all(chosen), target)


def _known(tables: Iterable[str] | None) -> list[str]:
    chosen = list(tables or BATCH_GOLD)
    unknown = sorted(set(chosen) - set(SERVING_TABLES))
    if unknown:
        raise ValueError(f"Unknown serving tables: {', '.join(unknown)}")
    return chosen


def realtime_loader(target: Target) -> Callable[[DataFrame], ServingLoad]:
    """For ``LiveMetrics.serve``: each micro-batch refreshes the serving copy, so no polling loop is needed."""
    return lambda metrics: replace_serving_table(metrics, "realtime_metrics", target)
