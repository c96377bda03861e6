"""Intermediate tables of the operators, in the shared folder that the session names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.session import scratch_root


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared scratch root; nothing else writes to it."""
    return f"{scratch_root(spark).rstrip('/')}/strata-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """Write ``df`` once and read it back, so that later work starts from files that outlive executors.

    A file has at most ``file_rows`` rows, if that is given.
    """
    path = folder(df.sparkSession, name)
    (df.write.option("maxRecordsPerFile", file_rows) if file_rows else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
