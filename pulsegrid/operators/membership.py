"""Leave out rows whose key is not in a set, before they move: a Bloom filter built by aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cells of one bitmap, as bitmap_construct_agg makes them.
BLOCK = 32_768
CELLS_PER_KEY = 16
PROBES = 3
# Bitmaps of 4 KB at most: 128 MB, for 67 million keys at full strength; more keys let more rows pass.
MAX_BLOCKS = 1 << 15


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(blocks))


def _cells(key: str) -> list[Column]:
    """Places of a key's cells in its block."""
    return [F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(k)), F.lit(BLOCK)) for k in range(1, PROBES + 1)]


def key_filter(keys: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Rows ``block``, ``bitmap`` of the cells of all ``keys``, and the number of blocks. Counts the keys when called."""
    blocks = max(1, min(MAX_BLOCKS, -(-keys.count() * CELLS_PER_KEY // BLOCK)))
    cells = keys.select(_block(key, blocks).alias("block"), F.explode(F.array(*_cells(key))).alias("at"))
    return cells.groupBy("block").agg(F.bitmap_construct_agg("at").alias("bitmap")), blocks


def maybe_in(df: DataFrame, key: str, bitmaps: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``df`` whose key may be one of those of the filter: none of these is lost, a few others pass.

    The bitmaps are broadcast (128 MB at most), so ``df`` keeps its partitioning and rows are tested where they are read.
    """

    def hit(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("__bitmap"), (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10)
        return F.getbit(byte.cast("int"), F.pmod(at, F.lit(8)).cast("int")) == 1

    held = F.broadcast(bitmaps.select(F.col("block").alias("__block"), F.col("bitmap").alias("__bitmap")))
    tested = df.join(held, _block(key, blocks) == F.col("__block"))
    for at in _cells(key):
        tested = tested.where(hit(at))
    return tested.select(*df.columns)
