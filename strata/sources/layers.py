"""Reading one layer of the lake."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = "execution_date"


def date_literal(execution_date: str | dt.date) -> Column:
    return F.lit(execution_date).cast("date")


def of_date(layer: DataFrame, execution_date: str | dt.date, column: str = PARTITION) -> DataFrame:
    """Rows of one execution date; a plain comparison, so partitions are pruned."""
    return layer.filter(F.col(column) == date_literal(execution_date))


def target_columns(spark: SparkSession, table: str) -> list[str]:
    """Column names of a catalog table, in table order."""
    return spark.table(table).columns
