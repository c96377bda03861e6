"""Where each layer of a data set lives, and how partitions of it are written and read."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.contracts import TableContract
from strata.sources.layers import PARTITION, of_date

RAW_SCHEMA = "execution_date date, request_hash string, page bigint, path string, records bigint, content string"


@dataclass(frozen=True)
class Lake:
    root: str
    dataset: str

    @property
    def raw_files(self) -> str:
        return f"{self.root}/raw/{self.dataset}"

    @property
    def raw_table(self) -> str:
        return f"{self.root}/raw_pages/{self.dataset}"

    def layer(self, layer: str, entity: str) -> str:
        return f"{self.root}/{layer}/{self.dataset}/{entity}"

    def quarantine(self, layer: str) -> str:
        return f"{self.root}/quarantine/{self.dataset}/{layer}"

    @property
    def logs(self) -> str:
        return f"{self.root}/logs"

    @property
    def claims(self) -> str:
        return f"{self.root}/claims/{self.dataset}"

    def table(self, contract: TableContract) -> str:
        return f"{self.root}/tables/{contract.database}/{contract.name}"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The Parquet layer at ``path``, without rows when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replace_partition(rows: DataFrame, path: str, execution_date: str, order: tuple[str, ...] = ()) -> None:
    """Write the rows of one execution date in place of what that date held, none included.

    The rows must not come from ``path`` itself.
    """
    sorted_rows = rows.sortWithinPartitions(*order) if order else rows
    sorted_rows.drop(PARTITION).write.mode("overwrite").parquet(f"{path}/{PARTITION}={execution_date}")


def written_rows(spark: SparkSession, paths: list[str], execution_date: str) -> int:
    """Rows the paths hold for the date, from the files themselves: a task that ran twice counts once."""
    parts = [
        spark.read.schema("_none boolean").parquet(f"{path}/{PARTITION}={execution_date}") for path in paths
    ]
    return reduce(DataFrame.union, parts).count()


def partition(spark: SparkSession, path: str, schema: T.StructType, execution_date: str) -> DataFrame:
    return of_date(read_or_empty(spark, path, schema), execution_date)
