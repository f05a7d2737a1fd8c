"""What the text operators share: document rows in Arrow batches, held-out rows, bounded labelled samples, staging."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from sluicebox.sources.storage import delete_path, fresh_folder

SLICE_ROWS = 256
_SHIPPED: set[str] = set()


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def doc_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Small slices of (doc_id, text) batches, so that only few texts are Python strings at a time."""
    for batch in batches:
        column = batch.schema.get_field_index("text")
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            yield part, part.column(column).to_pylist()


def map_texts(docs: DataFrame, per_slice: Callable[[list[str | None]], list], fields: str, keep: str = "doc_id") -> DataFrame:
    """One row per document: the ``keep`` columns, then what ``per_slice`` returns for a list of texts, column by column.

    ``per_slice`` is a generator function of no arguments called once per task; it yields a function of texts.
    """
    kept = keep.split()
    added = StructType.fromDDL(fields)
    schema = StructType([*docs.select(*kept).schema, *added])
    types = [to_arrow_type(field.dataType) for field in added]
    names = [field.name for field in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = per_slice()
        for part, texts in doc_slices(batches):
            columns = work(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index(name)) for name in kept] + [pa.array(c, t) for c, t in zip(columns, types)], names
            )

    return docs.select(*dict.fromkeys([*kept, "text"])).mapInArrow(run, schema)


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3


def held_out() -> Column:
    return fold() == 1


def fit_labels(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """About ``rows`` labelled documents outside the held-out fold, chosen by a hash of the id: (doc_id, label).

    Ids that carry both labels are left out. The result is bounded by ``rows`` whatever the table's size, so it may be broadcast.
    """
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("_other"))
        .where("label = _other")
        .drop("_other")
    )
    share = 1_000_000 * rows // max(rows, usable.count())
    return usable.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1_000_000)) < share)


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, text, label) of a bounded labelled sample; no text is shuffled."""
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, and a lost executor costs no recomputation."""
    path = fresh_folder(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_path = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for df in stored:
        delete_path(df.sparkSession, df.stored_path)


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 30) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter."""
    table = np.zeros(0x110000, dtype=np.int32)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000:
            char = chr(code)
            if char.isalpha():
                lower = char.lower()
                table[code] = ord(lower) if len(lower) == 1 else code
    return table


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, unless they get it from PYTHONPATH already."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    context = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or context.applicationId in _SHIPPED:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="sluicebox-"), "sluicebox_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "sluicebox")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
