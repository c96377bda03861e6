"""The stages: ingest, validate, staging, curated, warehouse. Each returns its row counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import DIMENSIONS, FACT, STAGING, TableContract, record_fields
from strata.functions.hashing import request_hash
from strata.operators import facts as fact_ops
from strata.operators import raw, records, standard, upsert, validation
from strata.operators.constraints import REASONS
from strata.plans import dates
from strata.plans.lake import PARTITION, RAW_SCHEMA, Lake, partition, replace_partition, written_rows
from strata.plans.tables import create_tables, key_range, publish
from strata.session import drop_path, materialise
from strata.sources import envelopes, manifest, pages

#: Gaps that the run log shows.
SHOWN_GAPS = 50
STAGING_ONLY = ("execution_date", "ingestion_timestamp")


class StageFailed(Exception):
    """A stage ended without success; ``report`` says why."""

    def __init__(self, message: str, report: dict | None = None) -> None:
        super().__init__(message)
        self.report = report or {}


def business_columns(contract: TableContract) -> list[str]:
    return [name for name in contract.names if name not in STAGING_ONLY]


#: Columns by which rows of a table are looked up.
LOOKUPS = ("numero_prestamo", "fecha_corte")


def layer_table(lake: Lake, layer: str, name: str) -> dates.Dated:
    contract = STAGING[name]
    return dates.of_layer(lake, layer, name, contract.schema, tuple(c for c in LOOKUPS if c in contract.names))


def fact_table(lake: Lake) -> dates.Dated:
    return dates.Dated(FACT.full_name, lake.table(FACT), FACT.schema, LOOKUPS)


def ingest(
    spark: SparkSession,
    lake: Lake,
    landed: DataFrame,
    *,
    execution_date: str,
    batch_ts: Column,
    endpoint: str,
    max_pages: int | None = None,
    overwrite: bool = False,
    key: tuple[str, ...] = raw.RAW_KEY,
) -> dict[str, object]:
    """Landed pages ``(page, payload)`` to the raw table; a page that is there already stays.

    What is written is decided on a narrow copy: page, number of records and digest of each payload, parsed once. Of
    payloads landed for the same page the one with the least digest stays. The documents themselves move once at
    most, and not at all where the list of wanted pages is small enough to be sent to them. ``key`` may be
    ``raw.PAGE_KEY``: then a page of the date counts as there whatever request it came from.
    """
    digest = F.sha2("payload", 256)
    narrow = pages.with_record_count(landed.select("page", "payload")).select("page", "records", digest.alias("digest"))
    counted, scratch = materialise(narrow, "page-counts")
    state_path = None
    try:
        date = F.lit(execution_date)
        kept = pages.keep_pages(counted, max_pages=max_pages)
        expected = kept.count()
        request = request_hash(F.lit(endpoint), date, F.col("page"), {"page": F.col("page")})
        copies = kept.groupBy("page", "digest").agg(F.max("records").alias("records"), F.count(F.lit(1)).alias("copies"))
        chosen = copies.groupBy("page").agg(F.min(F.struct("digest", "records", "copies")).alias("c")).select("page", "c.*")
        wanted = chosen.withColumns({"execution_date": date.cast("date"), "request_hash": request, "page": F.col("page").cast("bigint")})
        present = partition(spark, lake.raw_table, RAW_SCHEMA, execution_date)
        target = f"{lake.raw_table}/execution_date={execution_date}"
        before = present.agg(F.count(F.lit(1)).alias("pages"), F.sum("records").alias("records")).first()
        if not overwrite:
            wanted = wanted.join(present.select(*key), list(key), "left_anti")
        documents = landed.select(F.col("page").cast("bigint").alias("page"), "payload", digest.alias("digest")).join(wanted, ["page", "digest"])
        if not copies.where("copies > 1").isEmpty():
            again = documents.where("copies > 1").dropDuplicates(["page"])
            documents = documents.where("copies = 1").unionByName(again)
        fields = raw.metadata(date, F.lit(lake.dataset), batch_ts, F.col("request_hash"))
        batch = documents.select(
            "execution_date", "request_hash", "page",
            raw.page_path(lake.raw_files, date, F.col("request_hash"), F.col("page")).alias("path"),
            "records", raw.envelope(fields, F.col("payload")).alias("content"),
        )
        if overwrite:
            stays = present.join(wanted.select(*key), list(key), "left_anti")
            state, state_path = materialise(stays.unionByName(batch).drop("execution_date"), "raw")
            state.write.mode("overwrite").parquet(target)
        else:
            batch.drop("execution_date").write.mode("append").parquet(target)
        after = partition(spark, lake.raw_table, RAW_SCHEMA, execution_date)
        total = after.agg(F.count(F.lit(1)).alias("pages"), F.sum("records").alias("records")).first()
        below = counted if max_pages is None else counted.filter(F.col("page") <= max_pages)
        # Every gap is written; the run log shows the first ones and says when there are more.
        replace_partition(pages.missing_pages(below), lake.quarantine("raw_gaps"), execution_date)
    finally:
        drop_path(spark, scratch)
        if state_path:
            drop_path(spark, state_path)
    gaps = partition_of_gaps(spark, lake, execution_date).orderBy("first_missing").limit(SHOWN_GAPS + 1).collect()
    ranges = [f"{g[0]}-{g[1]}" if g[0] != g[1] else str(g[0]) for g in gaps]
    shown = ",".join(ranges[:SHOWN_GAPS]) + (",..." if len(ranges) > SHOWN_GAPS else "")
    return {
        "pages_expected": expected,
        "pages_loaded": total["pages"] - before["pages"],
        "records_loaded": (total["records"] or 0) - (before["records"] or 0),
        "missing_pages": shown or None,
    }


def partition_of_gaps(spark: SparkSession, lake: Lake, execution_date: str) -> DataFrame:
    """Ranges of pages that are missing from a date's raw data, all of them."""
    return spark.read.parquet(f"{lake.quarantine('raw_gaps')}/{PARTITION}={execution_date}").select("first_missing", "last_missing")


def validate(
    spark: SparkSession,
    lake: Lake,
    *,
    execution_date: str | None,
    from_files: bool = False,
) -> DataFrame:
    """The report of one raw partition, one row. Reads the raw table, or JSON files when asked to.

    The report shows the first violations; all of them are written as the date's rows of the quarantine layer
    ``raw_validation``.
    """
    listing = spark.createDataFrame([], manifest.SCHEMA)
    listing_error = None
    if execution_date and execution_date.strip():
        if from_files:
            try:
                listing = manifest.file_manifest(spark, manifest.partition_path(lake.raw_files, execution_date))
            except (manifest.PathMissing, OSError) as error:
                listing_error = str(error)
        else:
            listing = manifest.table_manifest(partition(spark, lake.raw_table, RAW_SCHEMA, execution_date))
    # Narrow: a path and a short list per file. Both the counts and the error list read it.
    checks = validation.file_checks(listing).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if execution_date and execution_date.strip():
            replace_partition(validation.violation_list(checks), lake.quarantine("raw_validation"), execution_date)
        row = validation.report(
            checks,
            execution_date=execution_date,
            dataset=lake.dataset,
            base_path=lake.raw_files,
            listing_error=listing_error,
        )
        schema = row.schema
        return spark.createDataFrame([row.first()], schema)
    finally:
        checks.unpersist()


def staging(
    spark: SparkSession,
    lake: Lake,
    *,
    execution_date: str,
    batch_ts: Column,
    source_names: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Raw envelopes to typed entity partitions.

    Envelopes are parsed once into a written copy of typed flat records; each entity then reads
    only its own columns of it. Elements that are no records go to the refused rows with their reason; the stage
    fails if records and refused elements do not add up to what the raw layer has counted.
    """
    fields = {f.name: f for contract in STAGING.values() for f in contract.fields}
    names = record_fields()
    raw_rows = partition(spark, lake.raw_table, RAW_SCHEMA, execution_date)
    elements = envelopes.result_elements(raw_rows, names, source_names=source_names)
    typed = records.typed_records(elements, [fields[name] for name in names], envelopes.REJECT, envelopes.ELEMENT)
    copy, scratch = materialise(
        records.with_technical_columns(typed, F.lit(execution_date), batch_ts), "records"
    )
    try:
        reject = F.col(envelopes.REJECT)
        flat = copy.filter(reject.isNull()).drop(envelopes.REJECT, envelopes.ELEMENT)
        refused = copy.filter(reject.isNotNull()).select(envelopes.ELEMENT, F.array(reject).alias(REASONS))
        _write_rejects(lake, "staging_records", {"element": refused}, execution_date)
        read = copy.filter(reject.isNull() | (reject == envelopes.NOT_OBJECT)).count()
        declared = raw_rows.agg(F.sum("records")).first()[0]
        if declared is not None and declared != read:
            raise ValueError(f"raw counts {declared} records of {execution_date}, staging read {read}")
        lost = flat.filter(F.size(records.ISSUES) > 0).select(*names, F.col(records.ISSUES).alias(REASONS))
        splits = records.split_entities(flat, STAGING, ("fecha_corte",))
        counts = {"rows_read": flat.count(), **_write_entities(spark, lake, "staging", splits, execution_date)}
        _write_rejects(lake, "staging_values", {"record": lost}, execution_date)
        counts["rows_with_lost_values"] = written_rows(spark, [lake.quarantine("staging_values")], execution_date)
    finally:
        drop_path(spark, scratch)
    return counts


def _write_rejects(lake: Lake, layer: str, rejects: dict[str, DataFrame], execution_date: str) -> None:
    """Refused rows of all entities in one place: the rules they break and the row as JSON."""
    shown = [
        rows.select(
            F.lit(name).alias("entity"),
            REASONS,
            F.to_json(F.struct(*[c for c in rows.columns if c != REASONS])).alias("row"),
        )
        for name, rows in rejects.items()
    ]
    replace_partition(reduce(DataFrame.unionByName, shown), lake.quarantine(layer), execution_date)


def _write_entities(
    spark: SparkSession, lake: Lake, layer: str, splits: dict[str, records.Entity], execution_date: str
) -> dict[str, int]:
    written = 0
    for name, split in splits.items():
        table = layer_table(lake, layer, name)
        dates.create(spark, table)
        written += dates.replace(split.rows, table, execution_date, STAGING[name].order)
    _write_rejects(lake, layer, {name: split.rejects for name, split in splits.items()}, execution_date)
    return {"rows_written": written, "rows_quarantined": written_rows(spark, [lake.quarantine(layer)], execution_date)}


def layer_rows(spark: SparkSession, lake: Lake, layer: str, name: str, execution_date: str) -> DataFrame:
    """One date of a layer's entity; none if the layer was never written."""
    table = layer_table(lake, layer, name)
    dates.create(spark, table)
    return dates.read(spark, table, execution_date)


def layer_count(spark: SparkSession, lake: Lake, layer: str, execution_date: str) -> int:
    """Rows of all entities of a layer's date, from the files alone."""
    return sum(layer_rows(spark, lake, layer, name, execution_date).count() for name in STAGING)


def curated(spark: SparkSession, lake: Lake, *, execution_date: str) -> dict[str, int]:
    """Staging partitions standardised, checked and deduplicated once more."""
    splits = {}
    for name, contract in STAGING.items():
        rows = layer_rows(spark, lake, "staging", name, execution_date)
        splits[name] = records.entity(standard.standardise(rows, contract), contract)
    read = layer_count(spark, lake, "staging", execution_date)
    return {"rows_read": read, **_write_entities(spark, lake, "curated", splits, execution_date)}


def load_dimension(
    spark: SparkSession, lake: Lake, name: str, *, execution_date: str, batch_ts: Column, count: str = "matched"
) -> dict[str, int]:
    """One dimension brought up to the execution date; rows per action."""
    contract = DIMENSIONS[name]
    batch = layer_rows(spark, lake, "curated", name, execution_date)
    when = {"execution_date": F.lit(execution_date), "batch_ts": batch_ts}
    present = upsert.present_members(spark.table(contract.full_name), batch, contract, count=count, **when)

    def added(matched: DataFrame) -> DataFrame:
        return upsert.new_members(matched, batch, contract, start=key_range(spark, lake, contract), **when)

    return publish(spark, lake, contract, present, added)


def load_fact(spark: SparkSession, lake: Lake, *, execution_date: str, batch_ts: Column) -> dict[str, int]:
    """The fact's snapshot of the execution date; a rerun replaces it and keeps known keys."""
    loans = spark.table(DIMENSIONS["prestamo"].full_name)
    tranches = spark.table(DIMENSIONS["tramo"].full_name)
    table = fact_table(lake)
    debts = records.fill_month_year(layer_rows(spark, lake, "curated", "deuda_corte", execution_date)).drop("ingestion_timestamp")
    first_load = not dates.has_date(spark, table, execution_date)
    present = None if first_load else dates.read(spark, table, execution_date)
    # References, orphans and known rows come from one copy of the facts, written once.
    matched = fact_ops.with_known(fact_ops.resolved(debts, tranches, loans), present)
    copy, scratch = materialise(matched, "resolved")
    try:
        whole = F.col("prestamo_key").isNotNull() & F.col("tramo_key").isNotNull()
        orphans = fact_ops.orphan_reasons(copy.where(~whole).drop(fact_ops.KNOWN_KEY, fact_ops.KNOWN_SINCE), loans)
        _write_rejects(lake, "warehouse", {FACT.name: orphans}, execution_date)
        missing = written_rows(spark, [lake.quarantine("warehouse")], execution_date)
        facts = copy.where(whole)
        total, updated = facts.agg(F.count(F.lit(1)), F.count(fact_ops.KNOWN_KEY)).first()
        if total:
            state = fact_ops.snapshot(facts, batch_ts=batch_ts, start=key_range(spark, lake, FACT))
            dates.replace(state, table, execution_date, FACT.order)
        elif not first_load:
            dates.remove(spark, table, execution_date)
    finally:
        drop_path(spark, scratch)
    return {upsert.INSERTED: total - updated, upsert.UPDATED: updated, "quarantined": missing}


def warehouse(
    spark: SparkSession, lake: Lake, *, execution_date: str, batch_ts: Column, count: str = "matched"
) -> dict[str, int]:
    """Model, five dimensions, fact; counts over all of them."""
    create_tables(spark, lake)
    read = layer_count(spark, lake, "curated", execution_date)
    totals = {"rows_read": read, "rows_inserted": 0, "rows_updated": 0, "rows_quarantined": 0}
    for name in DIMENSIONS:
        counts = load_dimension(
            spark, lake, name, execution_date=execution_date, batch_ts=batch_ts, count=count
        )
        totals["rows_inserted"] += counts.get(upsert.INSERTED, 0)
        totals["rows_updated"] += counts.get(upsert.UPDATED, 0)
    counts = load_fact(spark, lake, execution_date=execution_date, batch_ts=batch_ts)
    totals["rows_inserted"] += counts.get(upsert.INSERTED, 0)
    totals["rows_updated"] += counts.get(upsert.UPDATED, 0)
    totals["rows_quarantined"] += counts["quarantined"]
    totals["rows_written"] = totals["rows_inserted"] + totals["rows_updated"]
    return totals
