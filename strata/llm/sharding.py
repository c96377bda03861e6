"""Shards of nearly equal bytes, by longest-processing-time scheduling of groups that stay together.

Units are sorted by size and go to the least-loaded shard through a heap. A group of at least
``1 / units`` of all bytes is a unit of its own, so there are at most ``units`` of these, whatever the input. All smaller groups
are hashed into bundles of falling size classes, whose small ones level the loads at the end. So the driver schedules a bounded list,
and rows find their shard by a broadcast of that list.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.numbering import blocks_for, numbered

#: Overhead of a row besides its text. Fixed value.
ROW_BYTES = 16
UNITS = 1 << 14
#: Shares of the small groups that go to coarse, middle and fine bundles, in 256ths.
CLASSES = ((0, 240), (240, 255), (255, 256))


def longest_first(sizes: list[tuple[int, str]], shards: int) -> dict[str, int]:
    """Shard of every unit: largest first, each to the shard with the least load so far; ties by name and number."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for size, unit in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        out[unit] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``size``, ``text_crc32`` and the group (a digest of the text; null texts are one group)."""
    raw = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    group = F.when(F.col(text).isNull(), F.lit("null")).otherwise(F.md5(raw))
    return docs.select(
        F.col(key), (F.octet_length(raw) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(raw).cast("bigint").alias("text_crc32"), group.alias("group"))


def sharded(rows: DataFrame, key: str, shards: int, units: int = UNITS) -> DataFrame:
    """``rows`` (``key``, ``size``, ``group``, ..; a stored frame) with ``shard`` and ``slot``.

    Rows of a group share a shard. Slots run from 0 without gaps within a shard. Rows may repeat, and ``key``
    may be null: each row gets a slot of its own. An empty table stays empty. A group with more than a
    shard's part of all bytes has a shard to itself as far as the others allow.
    """
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    least = -(-(total or 0) // units)
    part = F.pmod(F.xxhash64("group"), F.lit(256))
    place = F.pmod(F.xxhash64(F.lit("bundle"), "group"), F.lit(units // len(CLASSES))).cast("string")
    bundle = F.concat(F.when(part < CLASSES[0][1], F.lit("a")).when(part < CLASSES[1][1], F.lit("b")).otherwise(F.lit("c")), place)
    sized = groups.withColumn("unit", F.when(F.col("bytes") >= least, F.col("group")).otherwise(bundle))
    listed = sized.groupBy("unit").agg(F.sum("bytes").alias("bytes")).toArrow()
    shard_of = longest_first(list(zip(listed.column("bytes").to_pylist(), listed.column("unit").to_pylist(), strict=True)), shards)
    spark = rows.sparkSession
    plan = spark.createDataFrame(list(shard_of.items()), "unit string, shard int")
    own = F.broadcast(plan.select(F.col("unit").alias("group"), F.col("shard").alias("_own")))
    shared = F.broadcast(plan.withColumnRenamed("shard", "_shared"))
    placed = rows.join(own, "group", "left").withColumn("unit", bundle).join(shared, "unit", "left")
    placed = placed.withColumn("shard", F.coalesce("_own", "_shared")).drop("_own", "_shared", "unit")
    blocks = max(16, blocks_for(count) // shards)
    return numbered(placed, ["shard"], [key, "group"], "slot", blocks)
