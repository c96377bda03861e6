"""Sends this package to the executors, whose Python workers import it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

import strata

_SENT = "_strata_sent"


def ship(spark: SparkSession) -> None:
    """Add the package to the files of the application, once; Spark copies it to every executor itself."""
    context = spark.sparkContext
    if getattr(context, _SENT, False):
        return
    package = Path(strata.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="strata-")) / "strata.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    setattr(context, _SENT, True)
