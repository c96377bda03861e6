"""Tables by execution date, each date of which is replaced as a whole or not at all.

A date's rows are written to a new folder of their own; then the catalog's partition is pointed at it. Until that one
step readers see the old rows, and a write that fails or is killed between tasks leaves a folder that no table
names. Readers prune dates by the catalog and never list folders of other dates.
"""

from __future__ import annotations

import datetime as dt
import uuid
import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.plans.lake import Lake
from strata.sources.layers import PARTITION, of_date

#: Writer options of every dated table: filters by which scans leave out row groups, for columns that are looked up.
BLOOM = "parquet.bloom.filter.enabled"


@dataclass(frozen=True)
class Dated:
    """A catalog table below ``root``; ``schema`` has its columns, the partition column among them."""

    name: str
    root: str
    schema: T.StructType
    lookups: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields if f.name != PARTITION]


def of_layer(lake: Lake, layer: str, entity: str, schema: T.StructType, lookups: tuple[str, ...] = ()) -> Dated:
    """A layer's table. The database carries the lake's root, so lakes in one catalog stay apart."""
    database = f"lake_{zlib.crc32(lake.root.encode()):08x}"
    return Dated(f"{database}.`{layer}_{lake.dataset}_{entity}`", lake.layer(layer, entity), schema, lookups)


def create(spark: SparkSession, table: Dated) -> None:
    """Create the table and its database unless they are there."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.name.partition('.')[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table.name} ({columns}) USING parquet PARTITIONED BY ({PARTITION}) LOCATION '{table.root}'")


def _spec(execution_date: str | dt.date) -> str:
    return f"PARTITION ({PARTITION} = '{dt.date.fromisoformat(str(execution_date)).isoformat()}')"


def has_date(spark: SparkSession, table: Dated, execution_date: str | dt.date) -> bool:
    return not spark.sql(f"SHOW PARTITIONS {table.name} {_spec(execution_date)}").isEmpty()


def point(spark: SparkSession, table: Dated, execution_date: str | dt.date, location: str) -> None:
    """Let the date's partition name ``location``: the one step that readers see."""
    spec = _spec(execution_date)
    if has_date(spark, table, execution_date):
        spark.sql(f"ALTER TABLE {table.name} {spec} SET LOCATION '{location}'")
    else:
        spark.sql(f"ALTER TABLE {table.name} ADD {spec} LOCATION '{location}'")


def replace(rows: DataFrame, table: Dated, execution_date: str | dt.date, order: tuple[str, ...] = ()) -> int:
    """Put ``rows`` in place of what the date held, none included; returns how many there are.

    ``rows`` may read the table itself. Rows are counted in the files, so a task that ran twice counts once.
    """
    spark = rows.sparkSession
    location = f"{table.root}/{PARTITION}={execution_date}/version-{uuid.uuid4().hex}"
    shown = rows.select(*[f"`{c}`" for c in table.columns])
    writer = (shown.sortWithinPartitions(*order) if order else shown).write
    for column in table.lookups:
        writer = writer.option(f"{BLOOM}#{column}", "true")
    writer.parquet(location)
    written = spark.read.schema("_none boolean").parquet(location).count()
    point(spark, table, execution_date, location)
    return written


def remove(spark: SparkSession, table: Dated, execution_date: str | dt.date) -> None:
    """Let the table no longer have the date."""
    spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS {_spec(execution_date)}")


def read(spark: SparkSession, table: Dated, execution_date: str | dt.date) -> DataFrame:
    """The rows of one date, in the order of the table's columns; none if the date was never written."""
    return of_date(spark.table(table.name), execution_date).select(*[f"`{f.name}`" for f in table.schema.fields])
