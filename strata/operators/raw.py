"""Raw layer: envelopes, partition paths and the idempotent append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.moments import iso_utc
from strata.functions.text import padded_page

RAW_KEY = ("execution_date", "request_hash", "page")
#: The key of the layout with one file per page of a date.
PAGE_KEY = ("execution_date", "page")


def metadata(execution_date: Column, source: Column, ingested: Column, request_hash: Column) -> Column:
    """The four text fields stored beside each payload."""
    return F.struct(
        execution_date.alias("execution_date"),
        source.alias("source"),
        iso_utc(ingested).alias("ingestion_timestamp"),
        request_hash.alias("request_hash"),
    )


def page_metadata(
    source_system: Column, execution_date: Column, page: Column, request_hash: Column, ingested: Column
) -> Column:
    """The five text fields of the page-per-file layout."""
    return F.struct(
        source_system.alias("source_system"),
        execution_date.alias("execution_date"),
        page.cast("string").alias("page_number"),
        request_hash.alias("request_hash"),
        iso_utc(ingested).alias("ingestion_timestamp_utc"),
    )


def envelope(metadata_fields: Column, payload_json: Column) -> Column:
    """``{"metadata": .., "payload": ..}`` as text; the payload is JSON already and stays as it is."""
    return F.concat(
        F.lit('{"metadata":'),
        F.to_json(metadata_fields, {"ignoreNullFields": "false"}),
        F.lit(',"payload":'),
        payload_json,
        F.lit("}"),
    )


def page_path(base: str, execution_date: Column, request_hash: Column, page: Column) -> Column:
    return F.concat(
        F.lit(f"{base}/execution_date="),
        execution_date,
        F.lit("/request_hash="),
        request_hash,
        F.lit("/page="),
        padded_page(page, 4),
        F.lit(".json"),
    )


def page_only_path(base: str, execution_date: Column, page: Column) -> Column:
    return F.concat(
        F.lit(f"{base}/execution_date="), execution_date, F.lit("/page="), padded_page(page, 3), F.lit(".json")
    )


def first_per_key(batch: DataFrame, keys: tuple[str, ...], order: tuple[str, ...] = ()) -> DataFrame:
    """One row per key: the least by ``order``, ties by all other columns.

    The least row is an aggregate, so every task sends at most one row per key to the shuffle.
    """
    ranked = [c for c in order if c not in keys]
    others = [c for c in batch.columns if c not in keys and c not in ranked]
    if not ranked and not others:
        return batch.distinct()
    return (
        batch.groupBy(*keys)
        .agg(F.min(F.struct(*ranked, *others)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*batch.columns)
    )


def new_rows(batch: DataFrame, existing: DataFrame, keys: tuple[str, ...] = RAW_KEY) -> DataFrame:
    """Rows to append: the first of each key, unless ``existing`` holds the key (first write wins)."""
    return first_per_key(batch, keys).join(existing.select(*keys), list(keys), "left_anti")


def append_outcome(batch: DataFrame, existing: DataFrame, keys: tuple[str, ...] = RAW_KEY) -> DataFrame:
    """The first row of each key with ``written``: false where the key was there before."""
    seen = existing.select(*keys).distinct().withColumn("_seen", F.lit(True))
    return (
        first_per_key(batch, keys)
        .join(seen, list(keys), "left")
        .withColumn("written", F.col("_seen").isNull())
        .drop("_seen")
    )


def overwritten(batch: DataFrame, existing: DataFrame, keys: tuple[str, ...] = RAW_KEY) -> DataFrame:
    """State after a write that replaces rows of the same key."""
    latest = first_per_key(batch, keys)
    kept = existing.join(latest.select(*keys), list(keys), "left_anti")
    return kept.unionByName(latest)
