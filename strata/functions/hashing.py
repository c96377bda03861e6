"""Request signatures: the identity of one page request."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ascii_escaped(text: Column) -> Column:
    """JSON text with every character above U+007E written as ``\\uXXXX`` (surrogate pairs above U+FFFF)."""

    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))

    def escape(char: Column) -> Column:
        code = F.ascii(char)
        above = code - F.lit(0x10000)
        pair = F.concat(
            unit(F.lit(0xD800) + F.shiftright(above, 10)),
            unit(F.lit(0xDC00) + above.bitwiseAND(F.lit(0x3FF))),
        )
        return F.when(code < 0x7F, char).when(code < 0x10000, unit(code)).otherwise(pair)

    escaped = F.array_join(F.transform(F.split(text, ""), escape), "")
    return F.when((F.octet_length(text) > F.length(text)) | F.contains(text, F.lit("\x7f")), escaped).otherwise(text)


def canonical_request(
    endpoint: Column, execution_date: Column, page: Column, params: Mapping[str, Column]
) -> Column:
    """Compact JSON of the request with its keys in alphabetical order."""
    request = F.struct(
        endpoint.alias("endpoint"),
        execution_date.alias("execution_date"),
        page.alias("page"),
        F.struct(*[params[name].alias(name) for name in sorted(params)]).alias("params"),
    )
    return _ascii_escaped(F.to_json(request, {"ignoreNullFields": "false"}))


def request_hash(
    endpoint: Column, execution_date: Column, page: Column, params: Mapping[str, Column]
) -> Column:
    """SHA-256 of the canonical request, in hex."""
    return F.sha2(canonical_request(endpoint, execution_date, page, params), 256)


def pipe_request_hash(system: Column, endpoint: Column, page: Column, execution_date: Column) -> Column:
    """SHA-256 of ``system|endpoint=..|page=..|execution_date=..``, in hex."""
    text = F.concat_ws(
        "|",
        system,
        F.concat(F.lit("endpoint="), endpoint),
        F.concat(F.lit("page="), page.cast("string")),
        F.concat(F.lit("execution_date="), execution_date),
    )
    return F.sha2(text, 256)
