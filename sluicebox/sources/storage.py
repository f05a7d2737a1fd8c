"""Stored tables, the shared working folder, and counted writes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULT_FORMAT = "parquet"
# Row hashes in hex are half of many rows. zstd halves them, Spark's default codec does not.
PARQUET_CODEC = "zstd"


def filesystem_path(spark: SparkSession, path: str):
    """Hadoop file system and path objects, so that any store Spark can reach works."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = filesystem_path(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = filesystem_path(spark, path)
    fs.delete(target, True)


def switch_path(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another: two renames, with the old folder put back if the second fails."""
    fs, target = filesystem_path(spark, path)
    _, source = filesystem_path(spark, new)
    _, aside = filesystem_path(spark, f"{path.rstrip('/')}__old-{uuid.uuid4().hex}")
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"Cannot move {path} aside")
    if not had:
        fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"Cannot move {new} to {path}")
    if had:
        fs.delete(aside, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    if not path_exists(spark, path):
        return []
    fs, target = filesystem_path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)]


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    fs, target = filesystem_path(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()


def put_new_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file as a whole, unless it exists: written beside its place, then renamed without overwriting."""
    side = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}.part"
    write_small_text(spark, side, text)
    hadoop, (_, source), (_, target) = spark._jvm.org.apache.hadoop.fs, filesystem_path(spark, side), filesystem_path(spark, path)
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.valueOf("NONE")
    context = hadoop.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(context.makeQualified(source), context.makeQualified(target), options)
        return True
    except Py4JJavaError as error:
        delete_path(spark, side)
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise


def open_small_text(spark: SparkSession, path: str) -> str:
    """The text of a small file, read by the driver itself; FileNotFoundError if there is none."""
    fs, target = filesystem_path(spark, path)
    try:
        stream = fs.open(target)
    except Py4JJavaError as error:
        if "FileNotFoundException" in str(error.java_exception):
            raise FileNotFoundError(path) from None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move a file that an earlier attempt may have moved already."""
    fs, old = filesystem_path(spark, source)
    _, new = filesystem_path(spark, target)
    if fs.exists(old):
        fs.mkdirs(new.getParent())
        if not fs.rename(old, new):
            raise OSError(f"Cannot move {source} to {target}")
    elif not fs.exists(new):
        raise FileNotFoundError(source)


def read_small_text(spark: SparkSession, path: str) -> str:
    return "\n".join(row.value for row in spark.read.text(path, wholetext=True).collect())


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Stored table is missing: {path}")
    return spark.read.format(fmt).load(path)


def read_tables(spark: SparkSession, root: str, names, fmt: str = DEFAULT_FORMAT) -> dict[str, DataFrame]:
    return {name: read_table(spark, f"{root}/{name}", fmt) for name in names}


def writer_of(df: DataFrame, fmt: str = DEFAULT_FORMAT) -> DataFrameWriter:
    writer = df.write.format(fmt)
    return writer.option("compression", PARQUET_CODEC) if fmt == "parquet" else writer


def write_counted(
    df: DataFrame,
    path: str,
    mode: str,
    fmt: str = DEFAULT_FORMAT,
    partition_by: tuple[str, ...] = (),
    **counts: Column,
) -> dict[str, int]:
    """Write a table and return its row count, and further counts, from that same single pass.

    A file table is overwritten beside itself and then switched: a write that fails leaves the old table as it was, and
    readers never see a part of the new one. ``fmt="delta"`` does this by its own log.
    """
    seen = Observation(f"write-{uuid.uuid4()}")
    measures = {"rows": F.count(F.lit(1)), **counts}
    observed = df.observe(seen, *[measure.alias(name) for name, measure in measures.items()])
    writer = writer_of(observed, fmt).mode(mode).partitionBy(*partition_by)
    if mode == "overwrite" and fmt == "delta":
        writer.option("overwriteSchema", "true").save(path)
    elif mode == "overwrite":
        side = f"{path.rstrip('/')}__next-{uuid.uuid4().hex}"
        try:
            writer.save(side)
            switch_path(df.sparkSession, side, path)
        finally:
            delete_path(df.sparkSession, side)
    else:
        writer.save(path)
    return {name: int(value or 0) for name, value in seen.get.items()}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by the session; a local session may do without the setting."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder that every executor can reach.")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sluicebox-"))
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_folder(spark: SparkSession) -> None:
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


class Staging:
    """Intermediate tables written to the shared folder, so lost executors cost no recomputation."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        writer_of(df).mode("overwrite").save(path)
        return self.spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession, label: str) -> Iterator[Staging]:
    folder = fresh_folder(spark, label)
    try:
        yield Staging(spark, folder)
    finally:
        delete_path(spark, folder)
