"""Lists of rule codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def codes(*pairs: tuple[Column, str]) -> Column:
    """The codes whose condition holds, in order."""
    none = F.array().cast("array<string>")
    found = [F.when(condition, F.array(F.lit(code))).otherwise(none) for condition, code in pairs]
    return F.concat(*found) if found else none
