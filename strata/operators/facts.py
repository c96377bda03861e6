"""Fact snapshots: reference lookup, surrogate keys, reload of one execution date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.contracts import FACT, TableContract
from strata.functions.codes import codes
from strata.operators.keys import BUCKETS, Start, assign_keys
from strata.operators.upsert import ACTION, INSERTED, UPDATED
from strata.session import materialise

LOAN = ["numero_prestamo"]
TRANCHE = ["numero_prestamo", "numero_tramo"]


def reference_keys(tranches: DataFrame, loans: DataFrame) -> DataFrame:
    """Both surrogates per tranche; the loan's is looked up once per tranche, not once per fact.

    Facts then join on loan and tranche number together, which spreads a loan that holds a large
    part of all facts over many tasks.
    """
    return tranches.select(*TRANCHE, "tramo_key").join(loans.select(*LOAN, "prestamo_key"), LOAN)


def with_reference_keys(facts: DataFrame, tranches: DataFrame, loans: DataFrame) -> DataFrame:
    """Facts whose loan and tranche both exist, with their surrogates."""
    return facts.join(reference_keys(tranches, loans), TRANCHE)


def unresolved(facts: DataFrame, tranches: DataFrame, loans: DataFrame) -> DataFrame:
    """Facts without their loan or tranche, with ``reasons`` ``FK:<column>``."""
    left = facts.join(reference_keys(tranches, loans), TRANCHE, "left_anti")
    marked = left.join(
        tranches.select(*TRANCHE, F.lit(True).alias("_tranche")), TRANCHE, "left"
    ).join(loans.select(*LOAN, F.lit(True).alias("_loan")), LOAN, "left")
    reasons = codes(
        (F.col("_loan").isNull(), "FK:numero_prestamo"), (F.col("_tranche").isNull(), "FK:numero_tramo")
    )
    return marked.withColumn("reasons", reasons).select(*facts.columns, "reasons")


def resolved(facts: DataFrame, tranches: DataFrame, loans: DataFrame) -> DataFrame:
    """Facts with the surrogates that exist, the others null: one join for keys and orphans together."""
    reference = tranches.select(*TRANCHE, "tramo_key").join(loans.select(*LOAN, "prestamo_key"), LOAN, "left")
    return facts.join(reference, TRANCHE, "left")


def orphan_reasons(orphans: DataFrame, loans: DataFrame) -> DataFrame:
    """The rows of :func:`resolved` that lack a surrogate, with ``reasons``. Of those without a tranche it looks up whether their
    loan exists."""
    marked = orphans.join(loans.select(*LOAN, F.lit(True).alias("_loan")), LOAN, "left")
    found = F.col("prestamo_key").isNotNull() | F.coalesce("_loan", F.lit(False))
    reasons = codes((~found, "FK:numero_prestamo"), (F.col("tramo_key").isNull(), "FK:numero_tramo"))
    return marked.withColumn("reasons", reasons).drop("_loan", "prestamo_key", "tramo_key").select(
        *[c for c in orphans.columns if c not in ("prestamo_key", "tramo_key")], "reasons")


#: Key and creation time that a fact has already, null for a new one.
KNOWN_KEY, KNOWN_SINCE = "_known_key", "_known_since"


def with_known(facts: DataFrame, current: DataFrame | None, contract: TableContract = FACT) -> DataFrame:
    """Facts with key and creation time that the date's present content has for them."""
    if current is None:
        return facts.withColumns({KNOWN_KEY: F.lit(None).cast("bigint"), KNOWN_SINCE: F.lit(None).cast("timestamp")})
    known = current.select(*contract.key, F.col(contract.surrogate).alias(KNOWN_KEY), F.col("created_at_utc").alias(KNOWN_SINCE))
    return facts.join(known, list(contract.key), "left")


def snapshot(
    matched: DataFrame, *, batch_ts: Column, start: Start, contract: TableContract = FACT, buckets: int = BUCKETS
) -> DataFrame:
    """The date's new content from rows of :func:`with_known`, a stored table: known rows keep key and creation time, new ones
    are numbered. Each row has ``load_action``."""
    stamp = batch_ts.cast("timestamp")
    known = matched.where(F.col(KNOWN_KEY).isNotNull()).withColumns({
        contract.surrogate: F.col(KNOWN_KEY), "created_at_utc": F.col(KNOWN_SINCE), "updated_at_utc": stamp, ACTION: F.lit(UPDATED)})
    new = matched.where(F.col(KNOWN_KEY).isNull()).drop(KNOWN_KEY, KNOWN_SINCE)
    inserted = assign_keys(new, list(contract.key), contract.surrogate, start, buckets).withColumns({
        "created_at_utc": stamp, "updated_at_utc": stamp, ACTION: F.lit(INSERTED)})
    return known.select(*contract.names, ACTION).unionByName(inserted.select(*contract.names, ACTION))


def load_snapshot(
    facts: DataFrame,
    current: DataFrame | None,
    *,
    batch_ts: Column,
    start: Start,
    contract: TableContract = FACT,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The new content of one execution date, each row with ``load_action``.

    ``facts`` carry the reference surrogates and are distinct on the natural key; ``current`` is
    the date's present content, None when it has none. Rows that were there keep key and
    creation time, rows no longer in ``facts`` go.
    """
    if current is None:
        stamp = batch_ts.cast("timestamp")
        return assign_keys(facts, list(contract.key), contract.surrogate, start, buckets).withColumns({
            "created_at_utc": stamp, "updated_at_utc": stamp, ACTION: F.lit(INSERTED)
        }).select(*contract.names, ACTION)
    matched, _ = materialise(with_known(facts, current, contract), "matched")
    return snapshot(matched, batch_ts=batch_ts, start=start, contract=contract, buckets=buckets)
