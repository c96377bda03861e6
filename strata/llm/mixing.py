"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in built-in functions only.

A source's target may be several times its size or a part of it: the mix first takes every document as often as whole
epochs fit, then a weighted sample without replacement for the rest. Each document draws the exponential key
``-ln(u) / weight``, ``u`` from a hash of its id and ``weight`` from its quality; in the order of these keys documents
are taken until the rest of the budget is used up. Rows are sorted by source and key over all partitions, each partition
sums sizes on its own, and sums of the partitions before it shift them, so a source with any share of the rows
is spread over many tasks and none of it is gathered.

Targets level out like water: sources share the total by weight, a target stops at ``most_epochs`` times its
source's size, and the excess is shared again by weight, until no target is above.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.scratch import stored

#: White space between words. Fixed values.
WORD_GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
#: Marks that lower a document's weight, and how much one per word does.
MARKS = "#*$%&|<>"
MARK_COST = 10
#: Rows that one partition is meant to sort.
BLOCK_ROWS = 200_000
#: Weights of the sources in order, repeating. Fixed values.
SOURCE_WEIGHTS = (1, 2, 3)
SEED = "mix"


def n_words(text: Column) -> Column:
    """Runs of characters other than ASCII white space in the whole text; null has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, WORD_GAP))).cast("bigint")


def quality_weight(text: Column, size: Column) -> Column:
    """Weight in (0, 1]: 1 without marks such as ``#`` or ``|``, and a half with one mark per ``MARK_COST`` words."""
    marks = F.coalesce(F.length(text) - F.length(F.translate(text, MARKS, "")), F.lit(0))
    return F.when(size > 0, size.cast("double") / (size + MARK_COST * marks).cast("double")).otherwise(F.lit(1.0))


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from 52 bits of a hash of the key; null keys share one."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << 52)


def in_order(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``_at``, its place from 0 in the order of ``order`` (unique), without one task seeing all rows."""
    ranged = stored(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned("_id", 33)
    counts = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition of the sort
    shift = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    inner = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumn("_part", part).join(shift, "_part").withColumn("_at", F.col("_shift") + inner).drop("_part", "_shift", "_id")


def targets(rows: DataFrame, weights: Sequence[int] = SOURCE_WEIGHTS, most_epochs: int = 3) -> DataFrame:
    """``_source``, ``source_size``, ``target`` of the sources of ``rows`` (``_source``, ``size``).

    The sources by code point, null last, weigh ``weights``, repeating, and share the sum of all sizes. A source without a
    word has the target 0. Only sums come to the driver.
    """
    sizes = rows.groupBy("_source").agg(F.sum("size").alias("source_size"))
    placed = in_order(sizes.withColumn("_null", F.col("_source").isNull()), ["_null", "_source"], "mix-sources")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod("_at", F.lit(len(weights))).cast("int")).cast("bigint")
    capped = stored(placed.select("_source", "source_size", weight.alias("_weight"), (F.col("source_size") * most_epochs).alias("_most")), "mix-weights")
    total = capped.agg(F.sum("source_size")).first()[0] or 0
    # Whole numbers decide which targets stop, so the level does not depend on the order of sums.
    wide = "decimal(38,0)"
    level, above = (0, 1), F.lit(False)
    while True:
        stopped, shared = capped.agg(F.sum(F.when(above, F.col("_most")).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("_weight")))).first()
        if not shared or (total - stopped, shared) == level:
            break
        level = (total - stopped, shared)
        above = F.col("_most").cast(wide) * F.lit(level[1]).cast(wide) <= F.lit(level[0]).cast(wide) * F.col("_weight").cast(wide)
    part = F.col("_weight") * F.lit(level[0] / level[1])
    return capped.select("_source", "source_size", F.when(above, F.col("_most").cast("double")).otherwise(part).alias("target"))


def mixed(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", keep: Sequence[str] = (),
    weights: Sequence[int] = SOURCE_WEIGHTS, most_epochs: int = 3, seed: str = SEED,
) -> DataFrame:
    """A row per document: ``doc_id``, ``source``, ``size`` (words), ``weight``, ``draw`` (its exponential key),
    ``source_size``, ``target``, ``copies`` (times that the mix takes it), ``taken`` (``size * copies``) and ``row``, a struct of the
    columns ``keep`` (null without any).

    The sample ends with the document that brings its source nearest to its target, so a source misses it by half
    of one document at most, and whole documents are taken, up to ``most_epochs`` times. Null texts and texts without a
    word have size 0 and are taken like others, at no cost. Null sources are a source of their own. Null keys share one draw;
    equal draws go by key, size, then checksum of the text, and rows that are equal in all of these may stand for
    each other. Rows that repeat a key count each. An empty table stays empty. Names of other columns do not matter.
    """
    held = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(None).cast("string")
    whole = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{key}`").alias("_key"), F.col(f"`{source}`").alias("_source"), whole.alias("_text"), n_words(whole).alias("size"), held.alias("_row"))
    rows = rows.withColumn("weight", quality_weight(F.col("_text"), F.col("size")))
    rows = rows.withColumn("draw", -F.log(uniform(F.col("_key"), seed)) / F.col("weight"))
    rows = rows.withColumn("_sum", F.crc32(F.encode(F.coalesce("_text", F.lit("")), "UTF-8"))).drop("_text")
    # The last column parts rows that are equal in all others, however many there are.
    rows = stored(rows.withColumn("_row_id", F.monotonically_increasing_id()), "mix-rows")

    order = ["_source", "draw", "_key", "size", "_sum", "_row_id"]
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    blocks = max(blocks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sorted_rows = stored(rows.repartitionByRange(blocks, *order).withColumn("_block", F.spark_partition_id()), "mix-order")
    parts = sorted_rows.groupBy("_source", "_block").agg(F.sum("size").alias("_part"))
    ahead = Window.partitionBy("_source").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.select(F.col("_source").alias("_s"), F.col("_block").alias("_b"), F.coalesce(F.sum("_part").over(ahead), F.lit(0)).alias("_shift"))
    plan = targets(rows, weights, most_epochs)
    whole_epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("_epochs", whole_epochs.cast("bigint")).withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
    shift = shift.join(plan.withColumnRenamed("_source", "_p"), F.col("_s").eqNullSafe(F.col("_p"))).drop("_p")

    inner = Window.partitionBy("_block", "_source").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = sorted_rows.withColumn("_upto", F.sum("size").over(inner))
    joined = summed.join(shift, (F.col("_block") == F.col("_b")) & F.col("_source").eqNullSafe(F.col("_s")))
    upto = F.col("_shift") + F.col("_upto")
    # The last document is taken if that leaves the source nearer to its target than to stop before it.
    drawn = (2 * upto - F.col("size")).cast("double") <= 2 * F.col("_rest")
    copies = F.col("_epochs") + F.when(drawn & (F.col("source_size") > 0), 1).otherwise(0)
    copies = F.least(copies, F.lit(most_epochs)).cast("bigint")
    return joined.select(
        F.col("_key").alias(key), F.col("_source").alias(source), "size", "weight", "draw", "source_size", "target",
        copies.alias("copies"), (F.col("size") * copies).alias("taken"), F.col("_row").alias("row"))


def repeated(mix: DataFrame, epoch: str = "_epoch") -> DataFrame:
    """The mix itself: the kept columns of every document as often as it is taken, numbered from 0 in ``epoch``."""
    times = mix.where("copies > 0").select("row", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias(epoch))
    return times.select("row.*", F.col(epoch))
