"""A keyed table for micro-batches, kept as a log: small deltas per day, read newest-wins, merged now and then.

``delta/log_day=D/version=N`` holds what batch N changed in day D; ``base/log_day=D/version=M`` holds the whole day as of
batch M. A batch writes the days it touches and nothing else. A day is its newest base with the newer deltas on top; once a day
has ``limit`` of them, the batch that touched it merges them into a new base, so a day costs few files to read, and each row
is written again only once per ``limit`` batches of its day. Days that rest are read as they are, without a shuffle.

A batch counts when its mark in ``_done`` exists, which is made after its deltas: readers see a batch in all its days or in
none. Batches have rising numbers; one that is marked already is left alone, so repeating it changes nothing. Merging keeps what
the base before it was made of until the next merge, for readers that have listed it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from sluicebox.operators.keys import latest_per_key
from sluicebox.sources.storage import child_names, delete_path, path_exists, switch_path, write_small_text

LIMIT = 8
KEPT_MARKS = 100
DAY, VERSION = "log_day", "version"


def _numbers(names: list[str], prefix: str = f"{VERSION}=") -> list[int]:
    return sorted(int(name.removeprefix(prefix)) for name in names if name.startswith(prefix))


@dataclass(frozen=True)
class KeyedLog:
    """Rows of ``schema`` with one row per ``key``; ``day`` is the SQL expression of a row's day, a function of its key."""

    spark: SparkSession
    path: str
    schema: StructType
    key: tuple[str, ...]
    day: str
    limit: int = LIMIT

    def versions(self) -> list[int]:
        """The newest finished batches."""
        return sorted(int(name) for name in child_names(self.spark, f"{self.path}/_done") if name.isdigit())

    def finished(self) -> int:
        return max(self.versions(), default=-1)

    def upsert(self, changes: DataFrame, version: int) -> None:
        """Batch ``version``: the given rows replace those of the same keys."""
        if version <= self.finished():
            return
        names = self.schema.names
        rows = changes.select(*names, F.expr(self.day).cast("string").alias(DAY), F.lit(version).cast("bigint").alias(VERSION))
        seen = Observation(f"log-{uuid.uuid4()}")
        ends = [f(DAY).alias(name) for f, name in ((F.min, "first"), (F.max, "last"))]
        (
            rows.repartition(DAY)
            .observe(seen, *ends)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY, VERSION)
            .parquet(f"{self.path}/delta")
        )
        first, last = seen.get["first"], seen.get["last"]
        self._mark(version)
        if first is not None:
            for name in self._days("delta"):
                day = name.removeprefix(f"{DAY}=")
                if first <= day <= last and path_exists(self.spark, f"{self.path}/delta/{name}/{VERSION}={version}"):
                    self._merge_day(name, version)

    def read(self) -> DataFrame | None:
        """All rows as of the newest finished batch; None before the first."""
        finished = self.finished()
        if finished < 0:
            return None
        resting, bases, deltas = [], [], []
        for name in sorted({*self._days("base"), *self._days("delta")}):
            base, newer = self._state(name, finished)
            own = [f"{self.path}/base/{name}/{VERSION}={base}"] if base is not None else []
            (bases if newer else resting).extend(own)
            deltas += [f"{self.path}/delta/{name}/{VERSION}={v}" for v in newer]
        out = self._read("base", resting).select(*self.schema.names)
        if deltas:
            open_days = self._read("base", bases).unionByName(self._read("delta", deltas))
            out = out.unionByName(self._newest(open_days))
        return out

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.key, [VERSION]).select(*self.schema.names)

    def _days(self, kind: str) -> list[str]:
        return [name for name in child_names(self.spark, f"{self.path}/{kind}") if name.startswith(f"{DAY}=")]

    def _state(self, name: str, finished: int) -> tuple[int | None, list[int]]:
        """(the newest base of a day, the finished deltas above it)."""
        base = max(_numbers(child_names(self.spark, f"{self.path}/base/{name}")), default=None)
        deltas = _numbers(child_names(self.spark, f"{self.path}/delta/{name}"))
        return base, [v for v in deltas if v <= finished and (base is None or v > base)]

    def _read(self, kind: str, paths: list[str]) -> DataFrame:
        schema = StructType([*self.schema.fields]).add(DAY, StringType()).add(VERSION, LongType())
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(*paths)

    def _merge_day(self, name: str, finished: int) -> None:
        before, newer = self._state(name, finished)
        if len(newer) < self.limit:
            return
        old = [f"{self.path}/base/{name}/{VERSION}={before}"] if before is not None else []
        rows = self._read("base", old).unionByName(self._read("delta", [f"{self.path}/delta/{name}/{VERSION}={v}" for v in newer]))
        side = f"{self.path}/base/{name}/_next-{uuid.uuid4().hex}"
        self._newest(rows).coalesce(1).write.parquet(side)
        switch_path(self.spark, side, f"{self.path}/base/{name}/{VERSION}={newer[-1]}")
        if before is not None:
            for kind, last in (("delta", before), ("base", before - 1)):
                for version in _numbers(child_names(self.spark, f"{self.path}/{kind}/{name}")):
                    if version <= last:
                        delete_path(self.spark, f"{self.path}/{kind}/{name}/{VERSION}={version}")

    def _mark(self, version: int) -> None:
        write_small_text(self.spark, f"{self.path}/_done/{version}", "")
        for old in self.versions()[:-KEPT_MARKS]:
            delete_path(self.spark, f"{self.path}/_done/{old}")
