"""Raw envelopes ``{"metadata": .., "payload": {"results": [..]}}`` and the records inside them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Why an element is no record: it is no object, or its whole document could not be parsed.
NOT_OBJECT = "NOT_OBJECT"
NOT_PARSED = "NOT_PARSED"
REJECT = "_reject"
ELEMENT = "_element"


def result_elements(
    raw: DataFrame,
    names: Iterable[str],
    *keep: str,
    content: str = "content",
    source_names: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per element of ``payload.results``: its place ``item``, its named members as text, ``_reject`` and ``_element``.

    ``source_names`` maps a column to the member it comes from. Elements are VARIANT values, so numbers keep all their
    digits. An element that is no object has a reason in ``_reject`` and its JSON text in ``_element``; so has a document that
    cannot be parsed, with the whole text and no ``item``. The outer form of the explode keeps the optimizer from testing
    the array's size, and so parsing the document once more, below it.

    One cast per element gives all members together, and is null for what is no object. It is the output of a generator, too:
    conditions on it would else be pushed below, and cast every element once more.
    """
    source_names = source_names or {}
    names = list(names)
    members = {name: source_names.get(name, name) for name in names}
    parsed = raw.select(*keep, F.col(content).alias("_content"), F.try_parse_json(content).alias("_document"))
    results = parsed.select(
        *keep,
        F.when(F.col("_content").isNotNull() & F.col("_document").isNull(), F.col("_content")).alias("_lost"),
        F.try_variant_get("_document", "$.payload.results", "array<variant>").alias("_results"),
    )
    exploded = results.select(*keep, "_lost", F.posexplode_outer("_results").alias("item", "_value"))
    wanted = sorted(set(members.values()))
    shape = "struct<" + ", ".join(f"{_quoted(member)}: string" for member in wanted) + ">" if wanted else "map<string, variant>"
    cast = exploded.select("*", F.explode_outer(F.array(F.try_variant_get("_value", "$", shape))).alias("_record"))
    odd = F.col("item").isNotNull() & F.col("_record").isNull()
    reason = F.when(F.col("_lost").isNotNull(), NOT_PARSED).when(odd, NOT_OBJECT)
    text = F.when(F.col("_lost").isNotNull(), F.col("_lost")).when(odd, F.coalesce(F.to_json("_value"), F.lit("null")))
    return cast.filter("item is not null or _lost is not null").select(
        *keep, "item", *[F.col("_record").getField(member).alias(name) for name, member in members.items()], reason.alias(REJECT), text.alias(ELEMENT)
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def result_records(
    raw: DataFrame,
    names: Iterable[str],
    *keep: str,
    content: str = "content",
    source_names: Mapping[str, str] | None = None,
) -> DataFrame:
    """The elements of :func:`result_elements` that are records: ``keep``, ``item`` and the members as text."""
    elements = result_elements(raw, names, *keep, content=content, source_names=source_names)
    return elements.filter(F.col(REJECT).isNull()).drop(REJECT, ELEMENT)
