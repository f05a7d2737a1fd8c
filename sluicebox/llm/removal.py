"""Filter interaction audit: what each filter removes, in every order in which the filters may run.

Every text gets a mask of the filters it fails. Texts are counted by (part, mask, labels) first, so what follows does not
grow with the table: a text with mask m leaves at the step ``min over f of (mask[m, f] + place[f, order])``, the min-plus
product of the mask matrix (0 where the filter fails, else infinite) and the places of the filters in each order (the
inverse permutations). These steps scatter the counts to (order, step).

Filters: A fewer than 200 words; B distinct words under half; C capitals above 3 %; D a markup symbol; E a copy of a text
with a smaller id. Copies are told by a 128-bit hash, so no text is shuffled; only hashes that occur under two or more ids are
kept for the join, and a hot hash is split there by adaptive execution.

Defined results: null text counts as empty, null lang as part ''; a null id is never smaller or larger than another, and
repeated rows of one id are no copies of each other; texts without words fail A only (and E); several labels of one id count
as one, 1 if any is 1; ids without labels are neither good nor toxic. No documents give no rows. Whole texts are used at any
length. Only doc_id, text and lang, and doc_id, quality and toxic of labels, are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import SLICE_ROWS, store

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
_ALL = bytes(range(256))
_NOT_CAPITAL = bytes(b for b in _ALL if not 65 <= b <= 90)
_NOT_SYMBOL = bytes(b for b in _ALL if b not in b"#$%&*|")
_INNER = bytes(range(0x80, 0xC0))  # bytes that do not begin a code point

TABLE = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
    "good_lost bigint, toxic_lost bigint, shapley bigint"
)


def text_mask(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails. ``bytes.split`` parts at exactly [\\x20\\x09-\\x0D]."""
    words = raw.split()
    capitals, points = len(raw.translate(None, _NOT_CAPITAL)), len(raw.translate(None, _INNER))
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * capitals > MAX_CAPITAL_PERCENT * points,
        len(raw.translate(None, _NOT_SYMBOL)) > 0,
    )
    return sum(1 << k for k, failed in enumerate(fails) if failed)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            raws = part.column(2).to_pylist()
            masks = pa.array([text_mask(raw) for raw in raws], pa.int32())
            digests = pa.array([blake2b(raw, digest_size=16).digest() for raw in raws], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), masks, digests], ["doc_id", "part", "mask", "digest"])


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents fail exactly these filters, by part and labels."""
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = store(rows.mapInArrow(_masks, f"doc_id {kind}, part string, mask int, digest binary"), "masks")
    ends = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copied = store(ends.where("first < last").drop("last"), "copied")
    flags = [F.max(F.coalesce(F.col(name) == 1, F.lit(False))).alias(flag) for name, flag in (("quality", "good"), ("toxic", "bad"))]
    marked = store(labels.where("quality = 1 or toxic = 1").groupBy("doc_id").agg(*flags), "marked")
    joined = rows.join(copied, "digest", "left").join(marked, "doc_id", "left")
    copy = F.when(F.col("doc_id") > F.col("first"), F.lit(COPY)).otherwise(0)
    good, bad = (F.coalesce(flag, F.lit(False)).alias(flag) for flag in ("good", "bad"))
    return joined.groupBy("part", F.col("mask").bitwiseOR(copy).alias("mask"), good, bad).agg(F.count("*").alias("n"))


def orders(filters: str = FILTERS) -> tuple[list[str], np.ndarray]:
    """All orders of the filters, and the place (from 1) of each filter in each order: (filter, order)."""
    names = ["".join(order) for order in permutations(filters)]
    return names, np.array([[name.index(f) + 1 for name in names] for f in filters])


def removal_steps(masks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Min-plus product: the step at which texts with each mask leave in each order; one past the last if they never do."""
    n = len(places)
    weights = np.where(masks[:, None] >> np.arange(n) & 1, 0.0, np.inf)
    return np.minimum((weights[:, :, None] + places[None]).min(axis=1), n + 1).astype(np.int64)


def audit_part(rows: pd.DataFrame, filters: str = FILTERS) -> pd.DataFrame:
    """All orders and steps of one part; ``rows`` holds one row per mask and label pair at most."""
    names, places = orders(filters)
    n, size = len(filters), len(names)
    masks, counts = rows["mask"].to_numpy(), rows["n"].to_numpy()
    steps = removal_steps(masks, places)

    def scatter(weights: np.ndarray) -> np.ndarray:
        cells = steps - 1 + (n + 1) * np.arange(size)
        out = np.zeros(size * (n + 1), np.int64)
        np.add.at(out, cells, np.broadcast_to(weights[:, None], cells.shape))
        return out.reshape(size, n + 1)[:, :n]

    removed = scatter(counts)
    at = np.array([[filters.index(f) for f in name] for name in names])  # (order, step) -> filter
    fails = np.array([counts[masks >> f & 1 == 1].sum() for f in range(n)])
    alone = np.array([counts[masks == 1 << f].sum() for f in range(n)])
    shapley = np.zeros(n, np.int64)
    np.add.at(shapley, at, removed)
    return pd.DataFrame({
        "part": rows["part"].iloc[0],
        "filter_order": np.repeat(names, n),
        "step": np.tile(np.arange(1, n + 1, dtype=np.int32), size),
        "kept": (counts.sum() - removed.cumsum(axis=1)).ravel(),
        "removed": removed.ravel(),
        "redundant": (fails[at] - removed).ravel(),
        "unique_fails": alone[at].ravel(),
        "good_lost": scatter(counts * rows["good"].to_numpy()).ravel(),
        "toxic_lost": scatter(counts * rows["bad"].to_numpy()).ravel(),
        "shapley": shapley[at].ravel(),
    })


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return masked(docs, labels).groupBy("part").applyInPandas(lambda rows: audit_part(rows), TABLE)
