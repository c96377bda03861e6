"""Gapless numbers within keys that may hold any share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one window of a key is meant to sort.
BLOCK_ROWS = 20_000
MOST_BLOCKS = 1 << 20


def blocks_for(rows: int) -> int:
    """How many blocks a table of so many rows is split into; small tables get a few, too."""
    return max(16, min(MOST_BLOCKS, -(-rows // BLOCK_ROWS)))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, blocks: int) -> DataFrame:
    """Add ``out``: numbers from 0 without gaps within ``keys``.

    Rows of a key are dealt to ``blocks`` by a hash of ``order``; each block is numbered on its own
    and shifted by the counts of the blocks before it. So no task sorts a whole key. Rows with
    equal ``order`` get neighbouring numbers in any order. The frame is read twice: store it first.
    """
    block: Column = F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int")
    dealt = df.withColumn("_block", block)
    counts = dealt.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("_block").alias("_b"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    inner = Window.partitionBy(*keys, "_block").orderBy(*order)
    local = dealt.withColumn("_local", F.row_number().over(inner) - 1)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("_block") == F.col("_b")]
    on = same[0]
    for c in same[1:]:
        on = on & c
    return local.join(shift, on).withColumn(out, F.col("_local") + F.col("_shift")).drop(
        "_block", "_local", "_b", "_shift", "_rows", *[f"_{k}" for k in keys])
