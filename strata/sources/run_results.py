"""Results of earlier stage runs: which run a stage refers to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.jsontext import is_falsy, member
from strata.functions.text import digits_only


def result_run_id(returned: Column) -> Column:
    """Run id out of a stage's returned JSON value.

    An object is unwrapped by its ``run_id``; numbers count as they are, text only when it is
    all digits, anything else gives null.
    """
    value = F.coalesce(member(returned, "$.run_id"), returned)
    encoded = F.to_json(value)
    return F.when(encoded.startswith('"'), digits_only(F.try_variant_get(value, "$", "string"))).when(
        encoded.rlike("^-?[0-9]+$"), F.try_variant_get(value, "$", "bigint")
    )


def previous_run_ids(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Add ``run_id`` of the stage each request asks about.

    ``results`` holds ``(stage_run, key, value)`` with JSON values. The value under
    ``return_value`` counts unless it is missing or falsy; then the one under ``run_id``.
    """
    parsed = results.withColumn("value", F.try_parse_json("value"))
    by_stage = parsed.groupBy("stage_run").agg(
        *[
            F.max(F.when((F.col("key") == key) & ~is_falsy(F.col("value")), F.to_json("value"))).alias(key)
            for key in ("return_value", "run_id")
        ]
    )
    chosen = by_stage.select(
        "stage_run", result_run_id(F.try_parse_json(F.coalesce("return_value", "run_id"))).alias("run_id")
    )
    return requests.join(chosen, "stage_run", "left")
