"""File manifests: every file of one raw partition as ``(path, length, content, reason)``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources import files

SCHEMA = "path string, length bigint, content binary"


class PathMissing(Exception):
    """The raw partition to list does not exist."""


def partition_path(base_path: str, execution_date: str) -> str:
    return f"{base_path}/execution_date={execution_date}"


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All files below ``path``, of any name and length, listed and read by tasks.

    A file that cannot be read has no content and a ``reason``. A store that only Spark can open is scanned instead
    (:func:`scanned_manifest`).
    """
    if not files.reachable(path):
        return scanned_manifest(spark, path)
    if not files.is_folder(path):
        raise PathMissing(path)
    return files.read(files.listed(spark, path))


def scanned_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The same by Spark's own scan, for stores that tasks cannot open themselves.

    The scan leaves out files of zero bytes, while the file index lists them. They are added as rows with empty content.
    Names that start with ``_`` or ``.`` stay hidden, and a file that cannot be read ends the scan.
    """
    try:
        found = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(path)
            .select(F.col("_metadata.file_path").alias("uri"), "length", "content")
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise PathMissing(path) from error
        raise
    # The names the file index holds on the driver already; contents are not read for the join.
    listed = spark.createDataFrame([(name,) for name in found.inputFiles()], "uri string").select(
        F.regexp_replace("uri", "^file:/+", "file:/").alias("uri")
    )
    empty = listed.join(found.select("uri"), "uri", "left_anti").select(
        "uri", F.lit(0).cast("bigint").alias("length"), F.lit(b"").alias("content")
    )
    path = F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B")))
    return found.unionByName(empty).select(path.alias("path"), "length", "content", F.lit(None).cast("string").alias("reason"))


def table_manifest(raw_pages: DataFrame) -> DataFrame:
    """The same manifest over the raw pages table, where one row stands for one file."""
    content = F.col("content").cast("binary")
    return raw_pages.select(
        "path", F.octet_length(content).cast("bigint").alias("length"), content.alias("content"), F.lit(None).cast("string").alias("reason")
    )
