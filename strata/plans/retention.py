"""Removing what no table names and no running load needs: old versions of tables and dates, and scratch copies.

Everything that a load writes is new: a version of a dimension, of a date, or a copy in the scratch folder. Until it
ends, a load may read and write any of these, so nothing that changed after the oldest open run began is touched, and
nothing younger than ``keep``. Of the rest, what the catalog names stays.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.contracts import DIMENSIONS, FACT, PIPELINE_RUNS, STAGING
from strata.operators import lifecycle
from strata.plans import dates, stages
from strata.plans.lake import PARTITION, Lake
from strata.session import drop_path, scratch_root

KEEP = dt.timedelta(days=7)
#: An open run that began longer ago has died without closing.
LONGEST_RUN = dt.timedelta(days=2)


def horizon(spark: SparkSession, keep: dt.timedelta = KEEP, now: dt.datetime | None = None) -> dt.datetime:
    """What changed before this moment may go."""
    now = now or dt.datetime.now(dt.timezone.utc)
    state = lifecycle.latest_state(spark.table(PIPELINE_RUNS.full_name))
    opened = state.where((F.col("status") == lifecycle.STARTED) & (F.col("started_at_utc") > F.lit(now - LONGEST_RUN)))
    first = opened.agg(F.unix_micros(F.min("started_at_utc"))).first()[0]
    began = now if first is None else dt.datetime.fromtimestamp(first / 1e6, dt.timezone.utc)
    return min(now - keep, began)


def _children(spark: SparkSession, folder: str) -> list[tuple[str, dt.datetime]]:
    """Path and time of the last change of everything in a folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    return [
        (f"{folder.rstrip('/')}/{status.getPath().getName()}", dt.datetime.fromtimestamp(status.getModificationTime() / 1e3, dt.timezone.utc))
        for status in system.listStatus(place)
    ]


def _location(spark: SparkSession, table: str, spec: str = "") -> str | None:
    """The name of the folder that a table, or a partition of it, points at."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table} {spec}").collect()
    found = [row["data_type"] for row in rows if row["col_name"] == "Location"]
    return found[0].rstrip("/").rpartition("/")[2] if found else None


def _drop(spark: SparkSession, found: list[tuple[str, dt.datetime]], before: dt.datetime, named: str | None) -> int:
    old = [path for path, changed in found if changed < before and path.rpartition("/")[2] != named]
    for path in old:
        drop_path(spark, path)
    return len(old)


def sweep_dates(spark: SparkSession, table: dates.Dated, before: dt.datetime) -> int:
    """Remove versions of a table's dates that no reader can reach; returns how many."""
    gone = 0
    for folder, _ in _children(spark, table.root):
        name = folder.rpartition("/")[2]
        if not name.startswith(f"{PARTITION}="):
            continue
        versions = _children(spark, folder)
        date = name.partition("=")[2]
        kept = _location(spark, table.name, dates._spec(date)) if dates.has_date(spark, table, date) else None
        gone += _drop(spark, versions, before, kept)
    return gone


def sweep(spark: SparkSession, lake: Lake, keep: dt.timedelta = KEEP, now: dt.datetime | None = None) -> dict[str, int]:
    """Remove old versions of all tables of the lake and old scratch copies; how many of each."""
    before = horizon(spark, keep, now)
    versions = 0
    for contract in DIMENSIONS.values():
        versions += _drop(spark, _children(spark, lake.table(contract)), before, _location(spark, contract.full_name))
    for layer in ("staging", "curated"):
        for name in STAGING:
            table = stages.layer_table(lake, layer, name)
            dates.create(spark, table)
            versions += sweep_dates(spark, table, before)
    versions += sweep_dates(spark, dates.Dated(FACT.full_name, lake.table(FACT), FACT.schema), before)
    copies = sum(_drop(spark, _children(spark, f"{scratch_root(spark).rstrip('/')}/{own}"), before, None) for own in ("strata", "strata-llm"))
    return {"versions": versions, "copies": copies}
