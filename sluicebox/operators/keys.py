"""Key operators: newest row per key, foreign keys, exact ranks over a whole table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Keep the newest row of each key.

    Spark plans ``row_number() = 1`` as a group limit that runs before the shuffle as well as after it:
    each task sends one row per key, so a key holding a third of the table does not overload one task.
    """
    order = [F.col(name).desc_nulls_last() for name in newest_first]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


# Keys that may be broadcast: some 80 bytes each in the driver and every executor, which a small compressed file hides.
BROADCAST_KEYS = 1_000_000
# Bitmaps that may be: 4 kB each, for 32,768 neighbouring ids.
BROADCAST_BITMAPS = 20_000

Keep = Callable[[DataFrame, str], DataFrame]


def looked_up(stored: DataFrame) -> DataFrame:
    """A stored set of keys as the side of a join that is looked up: many are never broadcast, whatever their file's size."""
    return stored.hint("merge") if stored.count() > BROADCAST_KEYS else stored


def stored_bitmaps(ids: DataFrame, key: str, keep: Keep, name: str) -> DataFrame | None:
    """Many distinct bigint ids as bitmaps, stored by ``keep``; None if they lie too far apart for that."""
    if dict(ids.dtypes)[key] != "bigint":
        return None
    placed = ids.select(F.bitmap_bucket_number(key).alias("_bucket"), F.bitmap_bit_position(key).alias("_bit")).where("_bucket IS NOT NULL")
    bitmaps = keep(placed.repartition("_bucket").groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")), f"{name}-bitmaps")
    return bitmaps if bitmaps.count() <= BROADCAST_BITMAPS else None


def in_bitmaps(child: DataFrame, bitmaps: DataFrame, key: str, name: str) -> DataFrame:
    """``child`` with a column that says whether its key is among the ids of the bitmaps, which are broadcast; false for a null key."""
    byte = F.conv(F.hex(F.substring("_bits", F.expr(f"CAST(bitmap_bit_position(`{key}`) DIV 8 AS INT) + 1"), F.lit(1))), 16, 10).cast("bigint")
    bit = byte.bitwiseAND(F.expr(f"shiftleft(1L, CAST(bitmap_bit_position(`{key}`) % 8 AS INT))"))
    placed = child.withColumn("_at", F.bitmap_bucket_number(key))
    found = placed.join(F.broadcast(bitmaps), F.col("_at") == F.col("_bucket"), "left")
    return found.withColumn(name, F.coalesce(bit != 0, F.lit(False))).drop("_at", "_bucket", "_bits")


def latest_per_key_of_stored(
    df: DataFrame, key: Sequence[str], newest_first: Sequence[str], keep: Keep, name: str
) -> tuple[DataFrame, DataFrame]:
    """``latest_per_key`` of a stored table, in two parts: rows that are alone with their key, and the newest of the others.

    Bare keys are counted first, and those that repeat are stored by ``keep``. Only their rows are shuffled and ranked, the
    others stay where they are. If too many repeat for a broadcast, the first part is empty and all rows are ranked.
    """
    repeated = keep(df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").drop("_rows"), name)
    found = repeated.count()
    if found == 0:
        return df, df.limit(0)
    if found <= BROADCAST_KEYS:
        renamed = F.broadcast(repeated.select(*[F.col(column).alias(f"_key_{column}") for column in key]))
        same = reduce(lambda a, b: a & b, [F.col(column).eqNullSafe(F.col(f"_key_{column}")) for column in key])
        return df.join(renamed, same, "left_anti"), latest_per_key(df.join(renamed, same, "left_semi"), key, newest_first)
    nulls = reduce(lambda a, b: a | b, [F.col(column).isNull() for column in key])
    bitmaps = stored_bitmaps(repeated, key[0], keep, name) if len(key) == 1 else None
    if bitmaps is None:
        return df.limit(0), latest_per_key(df, key, newest_first)
    marked = in_bitmaps(df, bitmaps, key[0], "_repeats").withColumn("_repeats", F.col("_repeats") | nulls)
    alone, others = marked.where("NOT _repeats").drop("_repeats"), marked.where("_repeats").drop("_repeats")
    return alone, latest_per_key(others, key, newest_first)


def newest_order(df: DataFrame) -> list[str]:
    """Newest ingestion wins, then the higher batch id; the row hash settles what is left."""
    return [name for name in ("ingestion_timestamp", "batch_id", "record_hash") if name in df.columns]


def with_parent(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    parent_key: str,
    missing: str,
    carry: dict[str, str] | None = None,
    unique_parent: bool = False,
) -> DataFrame:
    """Left-join the parent's keys: ``missing`` is true for a non-null key without a parent.

    ``carry`` maps parent columns to the names under which they come along. No hint is given: a small
    parent is broadcast from its measured size, a big one is sort-merged. Say ``unique_parent`` where the
    parent has one row per key (as every stored Silver table has): without a distinct step between shuffle
    and join, Spark can split the partition of a hot child key over several tasks.
    """
    carry = carry or {}
    found = f"_{missing}_found"
    columns = [F.col(parent_key).alias(key), F.lit(True).alias(found)]
    columns += [F.col(source).alias(target) for source, target in carry.items()]
    known = parent.select(*columns)
    if not unique_parent:
        known = known.dropDuplicates([key])
    return (
        child.join(known, key, "left")
        .withColumn(missing, F.col(key).isNotNull() & F.col(found).isNull())
        .drop(found)
    )


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Distinct non-null child keys that no parent has: two shuffles of bare keys, never of whole rows."""
    used = child.select(key).where(F.col(key).isNotNull()).distinct()
    return used.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def with_orphans(child: DataFrame, orphans: DataFrame, key: str, missing: str) -> DataFrame:
    """Same column as ``with_parent``, from a stored orphan set.

    Orphans are usually few: the size of the stored set lets Spark broadcast it, and the wide child is then not
    shuffled at all, however its keys are spread. A larger set is sort-merged, with hot keys split as in ``with_parent``.
    """
    marked = orphans.withColumn(missing, F.lit(True))
    return child.join(marked, key, "left").withColumn(missing, F.coalesce(missing, F.lit(False)))


def with_stored_orphans(child: DataFrame, orphans: DataFrame, key: str, missing: str, keep: Keep, name: str) -> DataFrame:
    """``with_orphans`` that shuffles the child only if the stored orphans are many and far apart."""
    if orphans.count() > BROADCAST_KEYS and (bitmaps := stored_bitmaps(orphans, key, keep, name)) is not None:
        return in_bitmaps(child, bitmaps, key, missing)
    return with_orphans(child, looked_up(orphans), key, missing)


def fk_orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key).alias(key)).distinct()
    return child.where(F.col(key).isNotNull()).join(keys, key, "left_anti")


def with_position(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Zero-based position of every row in a total order, without pulling rows into one task.

    Rows are range-partitioned and sorted; a position is the row's offset in its partition plus the sizes
    of the partitions before it. The sorted rows are checkpointed, because the sizes and the rows must
    come from the very same partitioning. Only one row per partition is summed up in a single task.
    """
    row_id = F.monotonically_increasing_id()
    placed = (
        df.orderBy(*order)
        .withColumn("_part", F.shiftright(row_id, 33))
        .withColumn("_offset", row_id.bitwiseAND(F.lit((1 << 33) - 1)))
        .checkpoint()
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn("position", F.col("_start") + F.col("_offset"))
        .drop("_part", "_offset", "_start")
    )
