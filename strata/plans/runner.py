"""Running stages in order, each between its lifecycle rows and with its audit always written."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import PIPELINE_RUNS, RUN_LOG
from strata.functions.text import safe_run_id
from strata.operators import lifecycle, metrics, runlog
from strata.operators.validation import MESSAGE_ERRORS
from strata.plans import stages, store
from strata.plans.lake import Lake
from strata.plans.stages import StageFailed
from strata.plans.store import claim
from strata.plans.tables import create_tables
from strata.sources import layers

# Where each stage reads and writes, as the run log names it.
ENDPOINTS = {
    "ingest": ("api", "adls_raw"),
    "raw_validation": ("adls_raw", "adls_raw"),
    "staging": ("adls_raw", "adls_staging"),
    "curated": ("adls_staging", "adls_curated"),
    "warehouse": ("adls_curated", "sql_warehouse"),
}


@dataclass(frozen=True)
class Run:
    """What identifies one run, and its batch time."""

    execution_date: str
    batch_ts: str
    dag_id: str = "load"
    run_id: str | None = None

    @property
    def moment(self) -> Column:
        return F.lit(self.batch_ts).cast("timestamp")


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _begin(spark: SparkSession, lake: Lake, run: Run, stage: str, began: dt.datetime) -> DataFrame:
    def highest() -> int:
        return spark.table(PIPELINE_RUNS.full_name).agg(F.max("audit_id")).first()[0] or 0

    # Loads that begin at the same time each get an id of their own.
    number = claim(spark, f"{lake.claims}/{PIPELINE_RUNS.name}", 1, highest)
    begun = spark.createDataFrame(
        [(number, run.dag_id, stage, lake.dataset, run.execution_date, began)],
        "audit_id bigint, pipeline_name string, stage string, dataset_name string, execution_date string, started_at_utc timestamp",
    ).withColumn("execution_date", F.col("execution_date").try_cast("date"))
    opened = lifecycle.started(begun)
    store.append(opened, PIPELINE_RUNS.full_name)
    return opened


def document_path(spark: SparkSession, lake: Lake, run: Run, stage: str) -> str:
    """Where the audit document of a stage's run lies; the same for a later try. The report on raw files has no layer."""
    one = spark.createDataFrame([(run.execution_date, lake.dataset)], "execution_date string, dataset_name string")
    layer = None if stage == "raw_validation" else stage
    run_id = safe_run_id(F.lit(run.run_id), run.moment)
    return runlog.log_document(one, written_at=run.moment, run_id=run_id, base=lake.logs, layer=layer).first()["log_path"]


def document(report: dict, lake: Lake, run: Run, stage: str, path: str) -> dict:
    """The audit document: the report's own fields, and what identifies the run. Times are ISO texts in UTC."""
    found = dict(report)
    if stage in metrics.EVENT_TYPES:
        found |= {
            "event_type": metrics.EVENT_TYPES[stage], "layer": stage, "airflow_run_id": run.run_id,
            "message": report.get("error_message") or metrics.DONE_MESSAGE, "audited_at_utc": report.get("ended_at_utc")}
    found |= {"dag_id": run.dag_id, "task_id": stage, "run_id": run.run_id, "log_path": path, "log_written_at_utc": _now()}
    return {name: value.isoformat() if isinstance(value, dt.datetime) else value for name, value in found.items()}


def write_document(spark: SparkSession, lake: Lake, run: Run, stage: str, report: dict) -> str:
    """The audit document as one file, in place of one from an earlier try; its path."""
    path = document_path(spark, lake, run, stage)
    text = json.dumps(document(report, lake, run, stage, path), ensure_ascii=False, default=str)
    store.put(spark, path, text.encode())
    return path


def write_run_log(spark: SparkSession, lake: Lake, run: Run, stage: str, report: dict) -> None:
    """One run log row, with the columns the table has."""
    source, target = ENDPOINTS[stage]
    row = spark.createDataFrame(
        [(
            run.run_id or "manual", run.dag_id, stage, run.execution_date, report["status"],
            report.get("error_message"), _now(), stage, lake.dataset, source, target,
            report["started_at_utc"], report["ended_at_utc"], report.get("error_message"),
            json.dumps(report, ensure_ascii=False, default=str), report.get("raw_path"),
        )],
        RUN_LOG_INPUT,
    )
    store.append(runlog.run_log_rows(row, layers.target_columns(spark, RUN_LOG.full_name)), RUN_LOG.full_name)


RUN_LOG_INPUT = ", ".join(
    f"{f.name} {'string' if f.name == 'execution_date' else f.type}" for f in RUN_LOG.fields
)


#: Texts of a failed audit, and widths of columns of the run table. Fixed values.
LOG_FAILED = "Fallo escritura log ADLS: {}"
AUDIT_FAILED = "Fallo auditoria SQL: {}"
MESSAGE_WIDTH = 2000
GAPS_WIDTH = 500


def short(text: str | None, width: int) -> str | None:
    """A text that fits a column; what is cut ends in dots. The documents hold the whole text."""
    return text if text is None or len(text) <= width else text[: width - 3] + "..."


def _count_against(report: dict, text: str) -> None:
    """Note an error that makes a report's stage fail. ``errors`` holds all of them, the message the first."""
    report["errors"] = [*report.get("errors", []), text]
    report.update(status=lifecycle.FAILED, error_message="; ".join(report["errors"][:MESSAGE_ERRORS]))


def run_stage(
    spark: SparkSession, lake: Lake, run: Run, stage: str, body: Callable[[], dict | DataFrame]
) -> dict:
    """STARTED row, the stage, its audit whatever happened, the closing row; then any failure.

    A stage may fail, and so may either of its two audit writes. Both are tried in every case.
    What is raised comes in this order: JSON log, run log, stage.
    """
    began = _now()
    opened = _begin(spark, lake, run, stage, began)
    failure: Exception | None = None
    report: dict = {"event_type": stage, "dataset_name": lake.dataset, "execution_date": run.execution_date}
    try:
        result = body()
        report.update(result.first().asDict(recursive=True) if isinstance(result, DataFrame) else result)
        report.setdefault("status", lifecycle.SUCCESS)
    except Exception as error:  # noqa: BLE001 - any failure of the stage is logged, then raised
        failure = error
        report.update(getattr(error, "report", {}), status=lifecycle.FAILED, error_message=str(error))
    report.update(started_at_utc=began, ended_at_utc=_now())

    def log() -> None:
        report["log_path"] = write_document(spark, lake, run, stage, report)

    # What went wrong in the audit itself, in the order in which it is raised.
    problems: list[StageFailed] = []
    for text, write in ((LOG_FAILED, log), (AUDIT_FAILED, lambda: write_run_log(spark, lake, run, stage, report))):
        try:
            write()
        except Exception as error:  # noqa: BLE001 - the other write is still tried
            problem = StageFailed(text.format(error), report)
            problem.__cause__ = error
            problems.append(problem)
            if text == LOG_FAILED:
                _count_against(report, str(problem))
    message = report.get("error_message") or "".join(str(p.__cause__) for p in problems)
    store.append(
        lifecycle.closed(
            opened,
            status=F.lit(lifecycle.FAILED if problems else report["status"]),
            ended=F.lit(report["ended_at_utc"]),
            error=F.lit(short(message, MESSAGE_WIDTH)),
            pages_expected=F.lit(report.get("pages_expected")),
            pages_loaded=F.lit(report.get("pages_loaded")),
            missing=F.lit(short(report.get("missing_pages"), GAPS_WIDTH)),
        ),
        PIPELINE_RUNS.full_name,
    )
    for problem in problems:
        raise problem
    if failure:
        raise failure
    if report["status"] != lifecycle.SUCCESS:
        raise StageFailed(report.get("error_message") or f"{stage} failed", report)
    return report


def pipeline_state(spark: SparkSession) -> DataFrame:
    """Every run with its latest status."""
    return lifecycle.latest_state(spark.table(PIPELINE_RUNS.full_name))


def run_load(
    spark: SparkSession,
    lake: Lake,
    landed: DataFrame,
    run: Run,
    *,
    endpoint: str,
    max_pages: int | None = None,
    overwrite: bool = False,
    source_names: dict[str, str] | None = None,
) -> dict[str, dict]:
    """All stages of one execution date in order; the first failure ends the load."""
    create_tables(spark, lake)
    when = {"execution_date": run.execution_date, "batch_ts": run.moment}
    steps: list[tuple[str, Callable[[], dict | DataFrame]]] = [
        ("ingest", lambda: stages.ingest(
            spark, lake, landed, endpoint=endpoint, max_pages=max_pages, overwrite=overwrite, **when)),
        ("raw_validation", lambda: stages.validate(spark, lake, execution_date=run.execution_date)),
        ("staging", lambda: stages.staging(spark, lake, source_names=source_names, **when)),
        ("curated", lambda: stages.curated(spark, lake, execution_date=run.execution_date)),
        ("warehouse", lambda: stages.warehouse(spark, lake, **when)),
    ]
    return {name: run_stage(spark, lake, run, name, body) for name, body in steps}
