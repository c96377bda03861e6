"""Catalog tables made from contracts, and publishing a new state of a dimension."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import ALL_TABLES, DATABASES, TableContract
from strata.operators.upsert import ACTION, KEPT
from strata.plans.lake import Lake
from strata.plans.store import claim

HIGHEST_KEY = "strata.highest_key"


def create_tables(spark: SparkSession, lake: Lake, contracts: tuple[TableContract, ...] = ALL_TABLES) -> None:
    """Create the databases and every table that does not exist yet."""
    for database in DATABASES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for contract in contracts:
        columns = ", ".join(f"{f.name} {f.ddl}{' NOT NULL' if f.required else ''}" for f in contract.fields)
        partitioned = f" PARTITIONED BY ({contract.partition})" if contract.partition else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {contract.full_name} ({columns}) USING parquet{partitioned} "
            f"LOCATION '{lake.table(contract)}/initial'"
        )


def highest_key(spark: SparkSession, contract: TableContract) -> int | None:
    """The highest surrogate key ever given out, as noted on the table; None before the first load."""
    row = spark.sql(f"SHOW TBLPROPERTIES {contract.full_name}").filter(f"key = '{HIGHEST_KEY}'").head()
    return int(row["value"]) if row else None


def note_highest_key(spark: SparkSession, contract: TableContract, key: int) -> None:
    spark.sql(f"ALTER TABLE {contract.full_name} SET TBLPROPERTIES ('{HIGHEST_KEY}' = '{key}')")


def key_range(spark: SparkSession, lake: Lake, contract: TableContract) -> Callable[[int], int]:
    """Gives the number before a range of so many keys that no other load gets, and notes the highest on the table."""

    def start(count: int) -> int:
        first = claim(spark, f"{lake.claims}/{contract.name}", count, lambda: highest_key(spark, contract) or 0)
        if count:
            note_highest_key(spark, contract, first + count - 1)
        return first - 1

    return start


def publish(
    spark: SparkSession, lake: Lake, contract: TableContract, present: DataFrame, added: Callable[[DataFrame], DataFrame]
) -> dict[str, int]:
    """Write a dimension's new state beside the present one and point the table at it; rows per action.

    ``present`` are the members as the load leaves them; ``added`` gives the new members, from those that the batch has
    matched. These are read from the files just written, so the dimension is joined with the batch once.

    Readers keep the old files until the pointer moves, and a load that fails before leaves the
    table as it was. Rows per action are counted in the files written.
    """
    location = f"{lake.table(contract)}/version-{uuid.uuid4().hex}"
    rows = present.select(*contract.names, ACTION)
    rows.write.parquet(location)
    matched = spark.read.schema(rows.schema).parquet(location).where(F.col(ACTION) != KEPT)
    added(matched).select(*contract.names, ACTION).write.mode("append").parquet(location)
    written = spark.read.schema(rows.schema).parquet(location)
    counts = {row[ACTION]: row["count"] for row in written.groupBy(ACTION).count().collect()}
    spark.sql(f"ALTER TABLE {contract.full_name} SET LOCATION '{location}'")
    return counts
