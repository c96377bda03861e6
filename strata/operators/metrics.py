"""Outcome of stage runs: status, message, times and row counts from run results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.jsontext import is_falsy, member, starts_object, with_document
from strata.functions.moments import from_epoch_ms, iso_utc
from strata.functions.numbers import int_or_zero

# Messages, statuses a metrics document may set, names a count goes by.
NO_RUN_MESSAGE = "No Databricks run_id found."
DONE_MESSAGE = "Run completed"
METRIC_STATUSES = ("SUCCESS", "FAILED")
COUNT_NAMES = {
    "rows_read": ("rows_read", "records_read"),
    "rows_inserted": ("rows_inserted", "inserted"),
    "rows_updated": ("rows_updated", "updated"),
}
EVENT_TYPES = {"curated": "curated_transformation", "warehouse": "warehouse_load"}
SOURCES = {"curated": ("adls_staging", "adls_curated"), "warehouse": ("adls_curated", "sql_warehouse")}


def _first_named(document: Column, names: tuple[str, ...]) -> Column:
    """The first name that is present counts, even when it holds null."""
    return F.coalesce(*[member(document, f"$.{name}") for name in names])


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def with_metrics(runs: DataFrame, layer: str, output: str = "output") -> DataFrame:
    """Add counts and the overrides ``metric_status`` and ``metric_message`` of the JSON output.

    Text that is no JSON object counts as absent. A warehouse document counts whole or not at
    all; of a curated one the read count stays when only the written count is bad. Overrides are
    lost with any bad count.
    """
    parsed = with_document(runs, F.when(starts_object(F.col(output)), F.col(output)), "_m")
    m = F.col("_m")
    if layer == "warehouse":
        parsed = parsed.withColumns({
            f"_{name}": int_or_zero(_first_named(m, names)) for name, names in COUNT_NAMES.items()
        })
        written = member(m, "$.rows_written")
        parsed = parsed.withColumn(
            "_rows_written",
            F.when(written.isNull(), F.col("_rows_inserted") + F.col("_rows_updated")).otherwise(int_or_zero(written)),
        )
        counts = [*COUNT_NAMES, "rows_written"]
        whole = F.lit(True)
        for name in counts:
            whole = whole & F.col(f"_{name}").isNotNull()
        good = {name: whole for name in counts}
    else:
        counts = ["rows_read", "rows_written"]
        parsed = parsed.withColumns({f"_{name}": int_or_zero(member(m, f"$.{name}")) for name in counts})
        read_good = F.col("_rows_read").isNotNull()
        whole = read_good & F.col("_rows_written").isNotNull()
        good = {"rows_read": read_good, "rows_written": whole}

    status = member(m, "$.status")
    message = member(m, "$.message")
    hashable = ~F.coalesce(F.to_json(status).rlike(r"^[\[{]"), F.lit(False))
    usable = m.isNotNull() & whole & hashable
    status_text = F.when(F.to_json(status).startswith('"'), F.try_variant_get(status, "$", "string"))
    return parsed.withColumns({
        **{name: F.when(m.isNotNull() & good[name], F.col(f"_{name}")).otherwise(_zero()) for name in counts},
        "metric_status": F.when(usable & status_text.isin(*METRIC_STATUSES), status_text),
        "metric_message": F.when(usable & ~is_falsy(message), F.try_variant_get(message, "$", "string")),
    }).drop("_m", *[f"_{name}" for name in counts])


def resolved_runs(runs: DataFrame, layer: str, batch_ts: Column) -> DataFrame:
    """Status, message, times and counts of each run.

    Columns read: ``run_id, run_page_url, start_time, end_time, state, tasks, output``. The
    first task's state comes before the run's own; the metrics document may override both.
    """
    task = F.try_element_at("tasks", F.lit(1))
    has_run = F.coalesce(F.col("run_id") != 0, F.lit(False))
    result_state = F.coalesce(
        F.nullif(task["state"]["result_state"], F.lit("")), F.col("state.result_state")
    )
    state_message = F.coalesce(
        F.nullif(task["state"]["state_message"], F.lit("")), F.col("state.state_message")
    )
    run_status = F.when(result_state == "SUCCESS", F.lit("SUCCESS")).otherwise(F.lit("FAILED"))
    run_message = F.coalesce(F.nullif(state_message, F.lit("")), F.lit(DONE_MESSAGE))
    counted = with_metrics(runs, layer)
    counts = [c for c in ("rows_read", "rows_inserted", "rows_updated", "rows_written") if c in counted.columns]
    return counted.withColumns({
        "status": F.when(~has_run, F.lit("FAILED")).otherwise(F.coalesce("metric_status", run_status)),
        "message": F.when(~has_run, F.lit(NO_RUN_MESSAGE)).otherwise(F.coalesce("metric_message", run_message)),
        "task_run_id": F.when(
            has_run, F.coalesce(F.nullif(task["run_id"], F.lit(0).cast("bigint")), F.col("run_id"))
        ),
        "run_page_url": F.when(has_run, F.col("run_page_url")),
        "started_at_utc": from_epoch_ms(F.when(has_run, F.col("start_time")), batch_ts),
        "ended_at_utc": from_epoch_ms(F.when(has_run, F.col("end_time")), batch_ts),
        **{name: F.when(has_run, F.col(name)).otherwise(_zero()) for name in counts},
    }).drop("metric_status", "metric_message")


def audit_payload(
    resolved: DataFrame, *, layer: str, dataset: str, execution_date: str, dag_id: str, task_id: str, batch_ts: Column
) -> DataFrame:
    """The audit record of each run: 16 fields for curated, 18 for the warehouse."""
    counts = ["rows_read", "rows_written"]
    if layer == "warehouse":
        counts = ["rows_read", "rows_inserted", "rows_updated", "rows_written"]
    return resolved.select(
        F.lit(EVENT_TYPES[layer]).alias("event_type"),
        F.lit(layer).alias("layer"),
        F.lit(dataset).alias("dataset_name"),
        F.lit(execution_date).alias("execution_date"),
        F.lit(dag_id).alias("dag_id"),
        F.lit(task_id).alias("task_id"),
        F.col("scheduler_run_id").alias("airflow_run_id"),
        F.col("run_id").alias("databricks_run_id"),
        F.col("run_page_url").alias("databricks_run_page_url"),
        *counts,
        "status",
        "message",
        "started_at_utc",
        "ended_at_utc",
        iso_utc(batch_ts).alias("audited_at_utc"),
    )


def audit_log_runs(payload: DataFrame, layer: str) -> DataFrame:
    """Audit records as run log input; only failures carry an error message."""
    source, target = SOURCES[layer]
    counts = [c for c in payload.columns if c.startswith("rows_")]
    kept = ["event_type", "layer", *counts, "databricks_run_id", "databricks_run_page_url", "message"]
    kept += [c for c in ("adls_log_path",) if c in payload.columns]
    return payload.select(
        "dag_id",
        "task_id",
        F.col("airflow_run_id").alias("run_id"),
        "execution_date",
        "status",
        F.col("layer").alias("stage"),
        "dataset_name",
        F.lit(source).alias("source"),
        F.lit(target).alias("target"),
        "started_at_utc",
        "ended_at_utc",
        F.when(F.col("status") != "SUCCESS", F.col("message")).alias("error_message"),
        F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}).alias("details_json"),
        F.lit(None).cast("string").alias("raw_path"),
    )
