"""Business standardisation of entity values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.contracts import TableContract
from strata.functions.text import collapse_blanks


def computed_once(rows: DataFrame) -> DataFrame:
    """The rows, their columns computed here. Conditions on them would else be pushed below, with all that the columns are
    made of."""
    return rows.select(F.inline_outer(F.array(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))))


def standardise(rows: DataFrame, contract: TableContract, upper: Iterable[str] | None = None) -> DataFrame:
    """Text trimmed with single blanks inside, blank as null, code columns in capitals."""
    capitals = set(contract.upper if upper is None else upper)
    changed = {}
    for field in contract.fields:
        if field.type == "string" and field.name in rows.columns:
            value = collapse_blanks(F.col(field.name))
            changed[field.name] = F.upper(value) if field.name in capitals else value
    return computed_once(rows.withColumns(changed))
