"""Windows over series of any length: blocks of rows, each with the rows before it that its frames reach.

``Window.partitionBy(key)`` sorts a whole series in one task. Here all rows get their position in the order of (key, order);
every ``block_rows`` positions are a block, and the last ``halo`` rows of a block are sent to the next block as well. A frame that
reaches at most ``halo`` rows back then finds all its rows inside the block, whichever series it belongs to, and the copies are
dropped after the windows. A series that holds half of all rows is spread like any other rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from sluicebox.operators.keys import with_position
from sluicebox.sources.storage import ensure_checkpoint_folder

BLOCK, POSITION = "_block", "position"


def with_halo(df: DataFrame, key: Sequence[str], order: Sequence[str], block_rows: int, halo: int) -> DataFrame:
    """``df`` with its position and block; the last ``halo`` rows of each block stand in the next block too."""
    if not 0 < halo <= block_rows:
        raise ValueError(f"A block must be at least as long as its halo: {block_rows} < {halo}")
    ensure_checkpoint_folder(df.sparkSession)
    placed = with_position(df, [*key, *order])
    own = F.floor(F.col(POSITION) / block_rows)
    late = F.col(POSITION) % block_rows >= block_rows - halo
    return placed.withColumn(BLOCK, F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))


def without_halo(df: DataFrame, block_rows: int) -> DataFrame:
    return df.filter(F.col(BLOCK) == F.floor(F.col(POSITION) / block_rows)).drop(BLOCK, POSITION)


def block_window(key: Sequence[str]) -> WindowSpec:
    """The rows of one series inside one block, in order."""
    return Window.partitionBy(BLOCK, *key).orderBy(POSITION)


def over_series(
    df: DataFrame, key: Sequence[str], order: Sequence[str], columns: Mapping[str, Column], block_rows: int, halo: int
) -> DataFrame:
    """Add window columns made with ``block_window(key)`` whose frames reach at most ``halo`` rows back."""
    return without_halo(with_halo(df, key, order, block_rows, halo).withColumns(dict(columns)), block_rows)
