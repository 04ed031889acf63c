"""Tables in the cluster's shared folder, to cut lineage and to be read more than once."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir).

    Where none is set, a local master gets one of our own, removed when the process ends; on a cluster
    that is an error, as each executor would write to a disk of its own.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="gleanrow-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/gleanrow/{spark.sparkContext.applicationId}"


#: The folder that scratch() has set, if any.
_INNER: ContextVar[str | None] = ContextVar("scratch", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_INNER.get() or run_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored within are removed at the end: what reads them must have been written elsewhere by then."""
    before = _INNER.set(new_path(spark, "scratch"))
    try:
        yield
    finally:
        dropped(spark, _INNER.get())
        _INNER.reset(before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends there and a lost executor loses nothing.

    Spark takes columns of it for as small as their part of its compressed files, and would broadcast a million ids
    for a few megabytes. So a table with a row for each listing is joined with hint("merge").
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Removes one table of ours that nothing reads any more, on any file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def clear(spark: SparkSession) -> None:
    """Removes this application's tables, on any file system; call it when no DataFrame reads them any more."""
    dropped(spark, run_dir(spark))
