"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A JSON object may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; the SQL warehouse folder where it names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"


def materialise(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the scratch folder and read it back.

    Later scans of the copy prune columns and need none of the work that led to it, also when
    executors are lost on the way.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/strata/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch copy made by :func:`materialise`."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)
