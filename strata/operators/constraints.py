"""Contract checks that Parquet tables do not make: required, width, key and reference."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.contracts import TableContract
from strata.functions.codes import codes

REASONS = "reasons"


def _breaches(contract: TableContract, columns: Iterable[str], octets: bool) -> list[tuple[Column, str]]:
    """Condition and code of every rule on the columns that are there; a null breaks no width."""
    present = set(columns)
    size = F.octet_length if octets else F.length
    fields = [f for f in contract.fields if f.name in present]
    found = [(F.col(f.name).isNull(), f"NOT_NULL:{f.name}") for f in fields if f.required]
    return found + [
        (F.col(f.name).isNotNull() & (size(F.col(f.name)) > f.width), f"WIDTH:{f.name}") for f in fields if f.width
    ]


def reasons(contract: TableContract, columns: Iterable[str], *, octets: bool = False) -> Column:
    """Codes of the rules a row breaks: ``NOT_NULL:<column>`` first, then ``WIDTH:<column>``.

    Width counts characters, or bytes with ``octets``.
    """
    return codes(*_breaches(contract, columns, octets))


def checked(rows: DataFrame, contract: TableContract, *, octets: bool = False) -> DataFrame:
    """Add ``reasons``; empty for a row the table may take."""
    return rows.withColumn(REASONS, reasons(contract, rows.columns, octets=octets))


def accepted(rows: DataFrame, contract: TableContract, *, octets: bool = False) -> DataFrame:
    """Rows that break no rule; plain conditions, so that null tests reach the scan."""
    for condition, _ in _breaches(contract, rows.columns, octets):
        rows = rows.filter(~condition)
    return rows


def rejected(rows: DataFrame, contract: TableContract, *, octets: bool = False) -> DataFrame:
    """Rows that break a rule, with their ``reasons``."""
    broken = F.lit(False)
    for condition, _ in _breaches(contract, rows.columns, octets):
        broken = broken | condition
    return checked(rows.filter(broken), contract, octets=octets)


def key_violations(rows: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def orphans(rows: DataFrame, parents: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose reference (``on``: column to parent column) finds no parent."""
    wanted = parents.select(*[F.col(parent).alias(f"_{child}") for child, parent in on.items()])
    match = F.lit(True)
    for child in on:
        match = match & (rows[child] == wanted[f"_{child}"])
    return rows.join(wanted, match, "left_anti")
