"""The Spark session of the tests."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

from strata.session import configure


def session() -> SparkSession:
    warehouse = tempfile.mkdtemp(prefix="strata-")
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("strata-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.checkpoint.dir", warehouse + "/checkpoints")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
