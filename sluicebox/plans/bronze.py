"""Bronze: raw text rows with load metadata; malformed lines set aside."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluicebox.contracts import CORRUPT, RAW_SOURCES, RawSource, raw_source
from sluicebox.functions.hashing import record_hash
from sluicebox.sources.csv import read_source_csv, require_sources
from sluicebox.sources.run_log import RunLog
from sluicebox.sources.storage import DEFAULT_FORMAT, writer_of


@dataclass(frozen=True)
class LoadCounts:
    """Rows read, kept and set aside for one table in one run."""

    table: str
    batch_id: str
    read: int
    written: int
    rejected: int


def with_load_metadata(
    df: DataFrame, source: RawSource, source_file: str, batch_id: str, loaded_at: Column | None = None
) -> DataFrame:
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp() if loaded_at is None else loaded_at,
            "source_system": F.lit(source.source_system),
            "source_file": F.lit(source_file),
            "batch_id": F.lit(batch_id),
            "record_hash": record_hash(source.columns),
        }
    )


def is_malformed() -> Column:
    return F.col(CORRUPT).isNotNull()


def split_malformed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows without the corrupt column, malformed rows with it)."""
    return df.filter(~is_malformed()).drop(CORRUPT), df.filter(is_malformed())


def load_source(
    spark: SparkSession,
    table: str,
    raw_root: str,
    bronze_root: str,
    quarantine_root: str,
    batch_id: str,
    fmt: str = DEFAULT_FORMAT,
    log: RunLog | None = None,
) -> LoadCounts:
    """Append one source. Counts come from the write itself; only files with lines that failed are parsed again.

    With a ``log`` (file formats only) a batch is loaded once, however often it is run, and its counts are kept.
    """
    if log is not None and fmt != DEFAULT_FORMAT:
        raise ValueError(f"A run log moves finished files, which format {fmt!r} does not allow")
    source = raw_source(table)
    path = f"{raw_root}/{source.file_name}"
    parsed = read_source_csv(spark, source, path).withColumn("_file", F.col("_metadata.file_path"))
    rows = with_load_metadata(parsed, source, path, batch_id)

    seen = Observation(f"bronze-{uuid.uuid4()}")
    counted = rows.observe(
        seen,
        F.count(F.lit(1)).alias("read"),
        F.count_if(is_malformed()).alias("malformed"),
        F.collect_set(F.when(is_malformed(), F.col("_file"))).alias("files"),  # at most the files that the driver has listed
    )
    good, _ = split_malformed(counted.drop("_file"))

    def set_aside() -> tuple[int, int, int]:
        read, malformed = int(seen.get["read"]), int(seen.get["malformed"])
        if malformed:
            _, bad = split_malformed(rows.where(F.col("_file").isin(list(seen.get["files"]))).drop("_file"))
            mode = "append" if log is None else "overwrite"
            writer_of(bad, fmt).mode(mode).save(f"{quarantine_root}/bronze/{table}/{batch_id}")
        return read, read - malformed, malformed

    if log is None:
        writer_of(good, fmt).mode("append").save(f"{bronze_root}/{table}")
        return LoadCounts(table, batch_id, *set_aside())
    found = log.append_once("bronze", batch_id, table, good, f"{bronze_root}/{table}", set_aside)
    return LoadCounts(table, batch_id, found["rows_read"], found["rows_written"], found["rows_rejected"])


def load_sources(
    spark: SparkSession,
    raw_root: str,
    bronze_root: str,
    quarantine_root: str,
    tables: Iterable[str] | None = None,
    batch_id: str | None = None,
    fmt: str = DEFAULT_FORMAT,
    log: RunLog | None = None,
) -> list[LoadCounts]:
    """Load all sources, or the named ones, under one batch id."""
    chosen = list(tables or RAW_SOURCES)
    require_sources(spark, raw_root, chosen)
    batch = batch_id or str(uuid.uuid4())
    return [load_source(spark, t, raw_root, bronze_root, quarantine_root, batch, fmt, log) for t in chosen]


def run_report(spark: SparkSession, counts: Iterable) -> DataFrame:
    """Read / written / rejected rows per table as an audit table."""
    rows = [(c.table, c.read, c.written, c.rejected) for c in counts]
    return spark.createDataFrame(rows, "table_name STRING, rows_read BIGINT, rows_written BIGINT, rows_rejected BIGINT")
