"""Single small files in the lake, put in place whole by one step, and ranges of ids that no two writers share.

All of it goes through the file system that Spark's own writers use. A file is written beside its place and then renamed
there, so readers see all of it or nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import drop_path, materialise

#: Claims that stay listed in a folder; older ones say nothing that these do not.
KEPT_CLAIMS = 32
#: Tries to get a claim, and the seconds between two.
TRIES, PAUSE = 1_000, 0.01


def _file_system(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _draft(spark: SparkSession, path: str, content: bytes):
    """The content in a new file beside ``path``."""
    system, place = _file_system(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    out = system.create(draft, False)
    try:
        out.write(content)
    finally:
        out.close()
    return system, place, draft


def put(spark: SparkSession, path: str, content: bytes) -> None:
    """Put a file in place of one that may be there."""
    jvm = spark.sparkContext._jvm
    _, place, draft = _draft(spark, path, content)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(draft, place, options)


def put_new(spark: SparkSession, path: str, content: bytes) -> bool:
    """Put a file in place unless one is there; whether it was put. Of several writers one succeeds."""
    jvm = spark.sparkContext._jvm
    system, place, draft = _draft(spark, path, content)
    try:
        if system.getScheme() == "file":
            # A rename would replace what is there; a link does not.
            files = jvm.java.nio.file.Files
            files.createLink(jvm.java.io.File(place.toUri().getPath()).toPath(), jvm.java.io.File(draft.toUri().getPath()).toPath())
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(draft, place, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(draft, False)
    return True


def get(spark: SparkSession, path: str) -> bytes:
    """The content of a small file."""
    system, place = _file_system(spark, path)
    source = system.open(place)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source))
    finally:
        source.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    system, place = _file_system(spark, folder)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def remove(spark: SparkSession, path: str) -> None:
    system, place = _file_system(spark, path)
    system.delete(place, True)


def append(rows: DataFrame, table: str) -> None:
    """Add a few rows to a Parquet table that others may be adding to at the same time.

    Writers that commit into one folder would share its temporary one, so the rows are written aside, and their files then moved
    into the table one by one, under names of their own.
    """
    spark = rows.sparkSession
    located = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
    target = spark.table(table)
    given = set(rows.columns)
    shown = rows.select(*[
        F.col(f.name).cast(f.dataType) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    _, path = materialise(shown.coalesce(1), "append")
    system, place = _file_system(spark, located)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system.mkdirs(place)
    source, folder = _file_system(spark, path)
    for status in source.listStatus(folder):
        name = status.getPath().getName()
        if name.endswith(".parquet"):
            draft = hadoop_path(place, f".{uuid.uuid4().hex}")
            spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(source, status.getPath(), system, draft, False, spark.sparkContext._jsc.hadoopConfiguration())
            if not system.rename(draft, hadoop_path(place, f"part-{uuid.uuid4().hex}.parquet")):
                raise OSError(f"rows could not be moved into {located}")
    drop_path(spark, path)
    spark.catalog.refreshTable(table)


def claim(spark: SparkSession, folder: str, count: int, floor: Callable[[], int] = lambda: 0) -> int:
    """The first of ``count`` ids that nobody else gets; the ids claimed in a folder have no gaps.

    A claim is a file with the next number that holds its range; of writers that try for the same number one gets it, and
    the others try for the next. ``floor`` is asked once, for the first claim: the highest id in use before.
    """
    for _ in range(TRIES):
        taken = [n for n in names(spark, folder) if n.startswith("claim-")]
        if taken:
            number, last = int(taken[-1][6:]) + 1, json.loads(get(spark, f"{folder}/{taken[-1]}"))["last"]
        else:
            number, last = 0, floor()
        if not count:
            return last + 1
        text = json.dumps({"first": last + 1, "last": last + count}).encode()
        if put_new(spark, f"{folder}/claim-{number:012d}", text):
            for old in taken[:-KEPT_CLAIMS]:
                remove(spark, f"{folder}/{old}")
            return last + 1
        time.sleep(PAUSE)
    raise TimeoutError(f"no claim in {folder} after {TRIES} tries")
