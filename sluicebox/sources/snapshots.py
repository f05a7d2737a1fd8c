"""Tables that are published together: versioned data folders and one manifest that names the current version of each.

A load writes new folders beside the published ones, which no reader knows, and then publishes all of them by creating one
small file, ``_manifests/<version>.json``. A reader takes the newest manifest once and reads every table by it, so it sees
all tables of one load or all of the load before, never a mix and never nothing. A load that fails publishes nothing.

The manifest is written under another name and renamed to its own, which must not exist yet: of two loads that end at the
same time one gets the version, and the other tries again on top of it. The store must offer a rename that does not
overwrite (as HDFS does, and as checkpoints of streams need too).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from sluicebox.sources.storage import child_names, delete_path, filesystem_path, open_small_text, put_new_text, write_counted

KEPT_VERSIONS = 3
ATTEMPTS = 20


class Conflict(RuntimeError):
    """Another load has replaced a table that this one was made from."""


@dataclass(frozen=True)
class View:
    """All tables as of one version. ``tables`` maps names to {path, rows, schema}."""

    spark: SparkSession
    root: str
    version: int
    tables: Mapping[str, dict]

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def path(self, name: str) -> str:
        if name not in self.tables:
            raise KeyError(f"No table {name!r} in version {self.version}")
        return f"{self.root}/{self.tables[name]['path']}"

    def rows(self, name: str) -> int:
        return self.tables[name]["rows"]

    def read(self, name: str) -> DataFrame:
        """No file is opened to learn the schema; it stands in the manifest."""
        path = self.path(name)
        return self.spark.read.schema(StructType.fromJson(self.tables[name]["schema"])).parquet(path)

    def read_all(self, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in (self.tables if names is None else names)}


@dataclass(frozen=True)
class Snapshots:
    """Tables under ``root``, of which the newest ``keep`` versions stay readable."""

    spark: SparkSession
    root: str
    keep: int = KEPT_VERSIONS

    def versions(self) -> list[int]:
        names = child_names(self.spark, f"{self.root}/_manifests")
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def at(self, version: int) -> View:
        return View(self.spark, self.root, version, self._manifest(version)["tables"])

    def current(self) -> View:
        """The newest version; before the first load, version 0 without tables."""
        for _ in range(ATTEMPTS):
            versions = self.versions()
            if not versions:
                return View(self.spark, self.root, 0, {})
            try:
                return self.at(versions[-1])
            except FileNotFoundError:  # many newer versions came, and this one went, since the listing
                continue
        raise OSError(f"Manifests under {self.root} go faster than they can be read")

    def read(self, name: str) -> DataFrame:
        return self.current().read(name)

    @contextmanager
    def load(self, base: View | None = None) -> Iterator[Load]:
        """Tables written inside are published together at the end, or not at all.

        ``base`` is the version the load was made from. If it is given, a table the load replaces must still be as it was
        there, else ``Conflict`` is raised; without it the last load wins.
        """
        load = Load(self, self.current() if base is None else base, checked=base is not None)
        try:
            yield load
            load._publish()
        except BaseException:
            load._abandon()
            raise
        self.expire()

    def commit(self, frames: Mapping[str, DataFrame], base: View | None = None) -> dict[str, int]:
        """Replace all given tables in one step and return their row counts."""
        with self.load(base) as load:
            for name, df in frames.items():
                load.write(name, df)
        return dict(load.counts)

    def expire(self) -> None:
        """Drop versions before the newest ``keep``, and the folders that only they name. Unpublished folders are left alone."""
        versions = self.versions()
        old, kept = versions[: -self.keep], versions[-self.keep :]
        if not old:
            return
        try:
            living = {entry["path"] for v in kept for entry in self._manifest(v)["tables"].values()}
        except FileNotFoundError:  # another load expires versions at this moment
            return
        for version in old:
            try:
                dead = {entry["path"] for entry in self._manifest(version)["tables"].values()} - living
            except FileNotFoundError:
                continue
            delete_path(self.spark, self._manifest_path(version))
            for path in dead:
                delete_path(self.spark, f"{self.root}/{path}")

    def sweep(self, older_than_hours: float = 24) -> list[str]:
        """Delete folders that no manifest names and that have not changed for a while: what ended loads left behind."""
        living = {entry["path"] for v in self.versions() for entry in self._manifest(v)["tables"].values()}
        fs, data = filesystem_path(self.spark, f"{self.root}/data")
        limit, gone = (time.time() - older_than_hours * 3600) * 1000, []
        for table in child_names(self.spark, f"{self.root}/data"):
            for status in fs.listStatus(filesystem_path(self.spark, f"{self.root}/data/{table}")[1]):
                path = f"data/{table}/{status.getPath().getName()}"
                if path not in living and status.getModificationTime() < limit:
                    delete_path(self.spark, f"{self.root}/{path}")
                    gone.append(path)
        return gone

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/_manifests/{version:012d}.json"

    def _manifest(self, version: int) -> dict:
        return json.loads(open_small_text(self.spark, self._manifest_path(version)))

    def _put_manifest(self, version: int, tables: Mapping[str, dict]) -> bool:
        """Create the manifest of a version as a whole; False if the version exists already."""
        return put_new_text(self.spark, self._manifest_path(version), json.dumps({"version": version, "tables": tables}))


@dataclass
class Load:
    """One load in progress: its own tables can be read before they are published."""

    store: Snapshots
    base: View
    checked: bool = False
    counts: dict[str, int] = field(default_factory=dict)
    entries: dict[str, dict] = field(default_factory=dict)

    def write(self, name: str, df: DataFrame, **counts: Column) -> dict[str, int]:
        """Write a table to a folder of its own; counts come from the same pass."""
        path = f"data/{name}/{uuid.uuid4().hex}"
        self.entries[name] = {"path": path, "rows": None, "schema": None}  # known before the write, so that a failure removes it
        seen = write_counted(df, f"{self.store.root}/{path}", "errorifexists", **counts)
        nullable = StructType.fromJson(json.loads(df.schema.json()))
        for item in nullable:
            item.nullable = True
        self.entries[name] = {"path": path, "rows": seen["rows"], "schema": json.loads(nullable.json())}
        self.counts[name] = seen["rows"]
        return seen

    def read(self, name: str) -> DataFrame:
        """A table of this load, or else of the version it began from."""
        tables = {**self.base.tables, **self.entries}
        return View(self.store.spark, self.store.root, self.base.version, tables).read(name)

    def _publish(self) -> None:
        for _ in range(ATTEMPTS):
            now = self.store.current()
            for name in self.entries:
                if self.checked and now.tables.get(name) != self.base.tables.get(name):
                    raise Conflict(f"Table {name!r} was replaced since version {self.base.version}")
            if self.store._put_manifest(now.version + 1, {**now.tables, **self.entries}):
                return
        raise Conflict(f"Other loads published {ATTEMPTS} times in a row")

    def _abandon(self) -> None:
        for entry in self.entries.values():
            delete_path(self.store.spark, f"{self.store.root}/{entry['path']}")
