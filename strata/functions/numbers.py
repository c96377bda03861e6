"""Lenient integers of metric documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.jsontext import is_falsy


def int_or_zero(value: Column) -> Column:
    """A VARIANT as BIGINT: 0 where falsy or missing, null where it is no integer.

    JSON numbers lose their fraction, ``true`` is 1, text must be a whole number.
    """
    encoded = F.to_json(value)
    text = F.trim(F.try_variant_get(value, "$", "string"))
    whole = F.when(
        text.rlike("^[+-]?[0-9]+(_[0-9]+)*$"),
        F.regexp_replace(text, "_", "").try_cast("bigint"),
    )
    return (
        F.when(is_falsy(value), F.lit(0).cast("bigint"))
        .when(encoded == "true", F.lit(1).cast("bigint"))
        .when(encoded.rlike("^-?[0-9]"), F.try_variant_get(value, "$", "bigint"))
        .when(encoded.startswith('"'), whole)
    )
