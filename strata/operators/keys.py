"""Surrogate keys: dense, unique, the same on every run over the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import materialise

BUCKETS = 4096

#: A file's place among the files of a write, by the numbers in its name.
_PART, _PIECE = r"part-(\d+)-", r"-c(\d+)\."


def key_bucket(keys: Iterable[str], buckets: int = BUCKETS) -> Column:
    """A bucket number that depends on the natural key alone.

    It is never null, and says so: else a test for null would hash every row at the scan too.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    number = F.pmod(F.conv(F.substring(digest, 1, 4), 16, 10).cast("int"), F.lit(buckets))
    return F.coalesce(number, F.lit(0))


#: The number before the first key: known, or asked for once it is known how many keys are needed.
Start = Column | int | Callable[[int], int]


def numbered(copy: DataFrame, name: str, start: Start = 0) -> DataFrame:
    """The rows of a stored Parquet copy with their place in it, ``start + 1, start + 2, ..``, as the first column ``name``.

    A row's place is that of its file, which is the number of rows in the files before it, and its own within the file,
    which the scan knows. So nothing is sorted, gathered or moved, however many files there are, and the same copy
    gives the same numbers to any reader. The driver sees one count per file.
    """
    file = F.col("_metadata.file_name")
    # The numbers are cut from the names of files, not from those of rows.
    counts = copy.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("rows")).select(
        F.regexp_extract("file", _PART, 1).cast("int").alias("part"), F.regexp_extract("file", _PIECE, 1).cast("int").alias("piece"), "file", "rows",
    ).toArrow().sort_by([("part", "ascending"), ("piece", "ascending")])
    rows = counts.column("rows").to_pylist()
    if not isinstance(start, Column):
        start = F.lit(start(sum(rows)) if callable(start) else start)
    before = pa.table({
        "_file": counts.column("file").cast(pa.string()), "_before": pa.array([0, *accumulate(rows[:-1])][: len(rows)], pa.int64())})
    shifts = copy.sparkSession.createDataFrame(before, "_file string, _before bigint")
    placed = copy.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return placed.join(shifts, "_file").select(
        (start + F.col("_before") + F.col("_row") + 1).cast("bigint").alias(name), *[f"`{c}`" for c in copy.columns])


def assign_keys(
    rows: DataFrame, keys: Iterable[str], name: str, start: Start = 0, buckets: int = BUCKETS
) -> DataFrame:
    """Number rows of distinct natural keys ``start + 1, start + 2, ..`` in ``(bucket, key)`` order.

    Rows are sorted by ranges, in as many tasks as the session's shuffles have, and written once; their places in that
    copy are the numbers (:func:`numbered`). Hashed buckets come first, so ranges are even whatever the keys look like: each task
    gets as many buckets as the next, and ``rows`` are read once. Only where tasks outnumber buckets are the ranges
    found by a look at the rows before. Numbers are a function of the data alone: a task or a load that runs again gives the same ones.
    """
    keys = list(keys)
    if not 0 < buckets <= 65536:
        raise ValueError("buckets must lie between 1 and 65536")
    placed = rows.withColumn("_bucket", key_bucket(keys, buckets))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if tasks <= buckets:
        task = F.expr(f"cast(_bucket * {tasks}L div {buckets} as int)")
        ordered = placed.repartitionById(tasks, task).sortWithinPartitions("_bucket", *keys)
    else:
        ordered = placed.orderBy("_bucket", *keys)
    copy, _ = materialise(ordered.drop("_bucket"), "numbered")
    return numbered(copy, name, start)


def highest_key(table: DataFrame, name: str) -> Column:
    """The highest key in use, 0 for an empty table, as a scalar subquery."""
    return table.agg(F.coalesce(F.max(name), F.lit(0).cast("bigint"))).scalar()
