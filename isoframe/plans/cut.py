"""Lineage cut by tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is made and set, but on a
    local master only: on a cluster each machine would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        folder = "file://" + tempfile.mkdtemp(prefix="isoframe-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/isoframe-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Where ``settled`` learns what was written on the way.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written in the shared folder and read again.

    A long plan that many results use is planned and run once, and what it made
    outlives an executor: a lost one costs only the tasks it ran.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    if (paths := _WRITTEN.get()) is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Shuffle files of a finished write are deleted at once, not when the driver
#: happens to collect its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Writes within leave no shuffle files."""
    before = spark.conf.get(TIDY, "false")
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(TIDY, before)


def kept_tidily(df: DataFrame, name: str) -> DataFrame:
    """``kept``, after which the shuffle files of the write are gone."""
    with tidy(df.sparkSession):
        return kept(df, name)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` gives, written; tables that were written for it alone are deleted."""
    before = _WRITTEN.set([])
    try:
        out = kept_tidily(make(), name)
        *steps, last = _WRITTEN.get()
    finally:
        _WRITTEN.reset(before)
    for path in steps:
        _delete(out.sparkSession, path)
    if (paths := _WRITTEN.get()) is not None:
        paths.append(last)
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that ``kept`` wrote and that nothing will read again."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        _delete(df.sparkSession, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget(spark: SparkSession) -> None:
    """Delete all tables that this application has written in that way.

    To be called once the results made from them are written.
    """
    _delete(spark, shared_dir(spark))
