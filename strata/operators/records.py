"""Flat text records to typed entity rows."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.contracts import Field, TableContract
from strata.functions.codes import codes
from strata.functions.moments import to_date_strict
from strata.functions.text import blank_to_null
from strata.operators.constraints import REASONS, accepted, rejected

ISSUES = "_issues"


def convert(field: Field, raw: Column) -> Column:
    """The text as the field's type, null when it does not fit; amounts round half up."""
    return raw if field.type == "string" else _parsed(field, blank_to_null(raw))


def _parsed(field: Field, text: Column) -> Column:
    return to_date_strict(text) if field.type == "date" else text.try_cast(field.type)


def typed_records(records: DataFrame, fields: Iterable[Field], *keep: str) -> DataFrame:
    """Typed columns, and in ``_issues`` a ``CAST:<column>`` for every value that was lost.

    A value is trimmed once and converted once, in a step each; ``_issues`` compares the results.
    """
    fields = list(fields)
    others = [f for f in fields if f.type != "string"]
    texts = records.select(
        *keep, *[f.name for f in fields], *[blank_to_null(F.col(f.name)).alias(f"_text_{f.name}") for f in others])
    both = texts.withColumns({f"_typed_{f.name}": _parsed(f, F.col(f"_text_{f.name}")) for f in others}) if others else texts
    lost = [(F.col(f"_text_{f.name}").isNotNull() & F.col(f"_typed_{f.name}").isNull(), f"CAST:{f.name}") for f in others]
    typed = [F.col(f.name if f.type == "string" else f"_typed_{f.name}").alias(f.name) for f in fields]
    return both.select(*keep, *typed, codes(*lost).alias(ISSUES))


def latest_per_key(rows: DataFrame, keys: Iterable[str], order: Iterable[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order``, ties by all other columns, nulls least.

    The greatest row is an aggregate, so each task sends at most one row per key to the shuffle,
    however many copies one key has.
    """
    keys = list(keys)
    ranked = [c for c in order if c not in keys]
    others = [c for c in rows.columns if c not in keys and c not in ranked]
    if not ranked and not others:
        return rows.distinct()
    return (
        rows.groupBy(*keys)
        .agg(F.max(F.struct(*ranked, *others)).alias("_row"))
        .select(*keys, "_row.*")
        .select(*rows.columns)
    )


def with_technical_columns(rows: DataFrame, execution_date: Column, batch_ts: Column) -> DataFrame:
    return rows.withColumns({
        "execution_date": execution_date.cast("date"),
        "ingestion_timestamp": batch_ts.cast("timestamp"),
    })


@dataclass(frozen=True)
class Entity:
    """Rows a table may take, one per key, and the rows it may not, with their ``reasons``."""

    rows: DataFrame
    rejects: DataFrame


def entity(records: DataFrame, contract: TableContract, order: Iterable[str] = ()) -> Entity:
    """One entity out of flat typed records.

    Rows that break the contract are set aside first, so they never win over a good row of the
    same key. The winner is the greatest by ``order``, which may name record columns outside the
    contract, then by all columns.
    """
    order = list(order)
    carried = [c for c in order if c not in contract.names]
    rows = records.select(*contract.names, *carried)
    winners = latest_per_key(accepted(rows, contract), contract.key, order)
    return Entity(winners.select(*contract.names), rejected(rows, contract).select(*contract.names, REASONS))


def split_entities(
    records: DataFrame, contracts: dict[str, TableContract], order: Iterable[str] = ()
) -> dict[str, Entity]:
    """Every entity of the flat records; each reads only its own columns of them."""
    return {name: entity(records, contract, order) for name, contract in contracts.items()}


def fill_month_year(rows: DataFrame, date: str = "fecha_corte", month: str = "mes_corte", year: str = "anio_corte") -> DataFrame:
    """Month and year of the cut-off date where the source gives none."""
    return rows.withColumns({
        month: F.coalesce(F.col(month), F.month(date)),
        year: F.coalesce(F.col(year), F.year(date)),
    })
