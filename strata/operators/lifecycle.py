"""Run lifecycle: STARTED rows, closing rows, and the state they add up to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.contracts import PIPELINE_RUNS

# States of a run.
STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"

EVENT_COLUMNS = PIPELINE_RUNS.names


def started(runs: DataFrame) -> DataFrame:
    """STARTED rows; ``runs`` gives a fresh ``audit_id``, pipeline, stage, dataset, date and start time."""
    return runs.withColumns({
        "status": F.lit(STARTED),
        "pages_expected": F.lit(None).cast("int"),
        "pages_loaded": F.lit(None).cast("int"),
        "missing_pages": F.lit(None).cast("string"),
        "ended_at_utc": F.lit(None).cast("timestamp"),
        "error_message": F.lit(None).cast("string"),
        "created_at_utc": F.col("started_at_utc"),
    }).select(*EVENT_COLUMNS)


def closed(
    open_rows: DataFrame,
    *,
    status: Column,
    ended: Column,
    error: Column | None = None,
    pages_expected: Column | None = None,
    pages_loaded: Column | None = None,
    missing: Column | None = None,
) -> DataFrame:
    """Closing rows for STARTED ones; the error message stays only with failures."""
    nothing = F.lit(None)
    return open_rows.withColumns({
        "status": status,
        "ended_at_utc": ended.cast("timestamp"),
        "error_message": F.when(status == FAILED, error if error is not None else nothing).cast("string"),
        "pages_expected": (pages_expected if pages_expected is not None else nothing).cast("int"),
        "pages_loaded": (pages_loaded if pages_loaded is not None else nothing).cast("int"),
        "missing_pages": (missing if missing is not None else nothing).cast("string"),
        "created_at_utc": ended.cast("timestamp"),
    }).select(*EVENT_COLUMNS)


def latest_state(events: DataFrame) -> DataFrame:
    """One row per run: its latest row, created when the run began.

    A closing row counts after the STARTED row of the same time.
    """
    rank = F.when(F.col("status") == STARTED, F.lit(0)).otherwise(F.lit(1))
    body = [c for c in EVENT_COLUMNS if c not in ("audit_id", "created_at_utc")]
    return (
        events.groupBy("audit_id")
        .agg(
            F.max(F.struct(rank, F.col("created_at_utc").alias("_at"), F.struct(*body).alias("_row"))).alias("_last"),
            F.min("created_at_utc").alias("created_at_utc"),
        )
        .select("audit_id", "_last._row.*", "created_at_utc")
        .select(*EVENT_COLUMNS)
    )
