"""Type-1 upsert of a dimension: latest values win, keys and creation times stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.contracts import TableContract
from strata.operators.keys import BUCKETS, Start, assign_keys, highest_key

ACTION = "load_action"
INSERTED, UPDATED, UNCHANGED, STALE, KEPT = "inserted", "updated", "unchanged", "stale", "kept"


def _matching(contract: TableContract, name: str, collation: str | None) -> Column:
    column = F.col(name)
    if collation and contract.field(name).type == "string":
        return F.collate(column, collation)
    return column


def _with_match(rows: DataFrame, contract: TableContract, collation: str | None) -> DataFrame:
    return rows.withColumns({f"_on_{k}": _matching(contract, k, collation) for k in contract.key})


_TAIL = ("last_execution_date", "created_at_utc", "updated_at_utc")


def _values(contract: TableContract) -> list[str]:
    return [n for n in contract.names if n not in contract.key and n not in _TAIL and n != contract.surrogate]


def present_members(
    target: DataFrame, source: DataFrame, contract: TableContract, *, execution_date: Column, batch_ts: Column, count: str = "matched",
    collation: str | None = None,
) -> DataFrame:
    """The members that the dimension has, as the load leaves them, each with ``load_action``.

    Members are matched by a left join, so a small batch can be broadcast and the dimension is
    then not shuffled.
    """
    values, joined_on = _values(contract), [f"_on_{k}" for k in contract.key]
    incoming = _with_match(source.select(*contract.key, *values), contract, collation)
    news = incoming.select(*joined_on, F.struct(*values).alias("_new") if values else F.lit(True).alias("_new"))
    current = _with_match(target.select(*contract.names), contract, collation)
    matched = F.col("_new").isNotNull()
    taken = matched & (execution_date.cast("date") >= F.col("last_execution_date"))
    differs = F.lit(False)
    for name in values:
        differs = differs | ~F.col(name).eqNullSafe(F.col(f"_new.{name}"))
    updated = F.lit(UPDATED) if count == "matched" else F.when(differs, F.lit(UPDATED)).otherwise(F.lit(UNCHANGED))
    action = F.when(taken, updated).when(matched, F.lit(STALE)).otherwise(F.lit(KEPT))
    return current.join(news, joined_on, "left").withColumn(ACTION, action).select(
        contract.surrogate,
        *contract.key,
        *[F.when(taken, F.col(f"_new.{n}")).otherwise(F.col(n)).alias(n) for n in values],
        F.when(taken, execution_date.cast("date")).otherwise(F.col(_TAIL[0])).alias(_TAIL[0]),
        "created_at_utc",
        F.when(taken, batch_ts.cast("timestamp")).otherwise(F.col("updated_at_utc")).alias(_TAIL[2]),
        ACTION,
    )


def new_members(
    known: DataFrame, source: DataFrame, contract: TableContract, *, execution_date: Column, batch_ts: Column, start: Start,
    collation: str | None = None, buckets: int = BUCKETS,
) -> DataFrame:
    """Numbered rows for what ``known`` (rows with the natural key) does not have. ``known`` may be the members that the batch
    matched alone, which are never more than the batch."""
    keys, joined_on = list(contract.key), [f"_on_{k}" for k in contract.key]
    incoming = _with_match(source.select(*keys, *_values(contract)), contract, collation)
    held = _with_match(known.select(*keys), contract, collation).select(*joined_on)
    unseen = incoming.join(held, joined_on, "left_anti").select(*keys, *_values(contract))
    stamp = batch_ts.cast("timestamp")
    return assign_keys(unseen, keys, contract.surrogate, start, buckets).withColumns({
        _TAIL[0]: execution_date.cast("date"), _TAIL[1]: stamp, _TAIL[2]: stamp, ACTION: F.lit(INSERTED)})


def merge_dimension(
    target: DataFrame,
    source: DataFrame,
    contract: TableContract,
    *,
    execution_date: Column,
    batch_ts: Column,
    count: str = "matched",
    start: Start | None = None,
    collation: str | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The dimension after the load, each row with ``load_action``.

    ``source`` holds the business columns, one row per natural key. A matched member takes the
    source's values unless it was last loaded for a later date. With ``count="changed"`` only
    members whose values differ count as updated, the other matched ones as unchanged.
    ``collation`` compares text keys under a named collation. New members alone are numbered.
    """
    when = {"execution_date": execution_date, "batch_ts": batch_ts, "collation": collation}
    if start is None:
        start = highest_key(target, contract.surrogate)
    merged = present_members(target, source, contract, count=count, **when)
    inserted = new_members(target, source, contract, start=start, buckets=buckets, **when)
    return merged.select(*contract.names, ACTION).unionByName(inserted.select(*contract.names, ACTION))


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per ``load_action``."""
    return merged.groupBy(ACTION).agg(F.count(F.lit(1)).alias("rows"))
