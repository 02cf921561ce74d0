"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a temporary folder only where it is unset and all runs in one process (tests)."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = getattr(shared_dir, "own", None)
    if own is None or not os.path.isdir(own):
        own = tempfile.mkdtemp(prefix="sieveyard-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        shared_dir.own = own
    return f"file://{own}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def local_path(uri: str) -> str:
    """A mounted path's name for code that opens files itself."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    if "://" in uri:
        raise ValueError(f"this needs a folder that is mounted on every node, not {uri}")
    return uri


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of every executor, once an application: they may not have it on their path."""
    context = spark.sparkContext
    if getattr(ship_package, "done", None) == context.applicationId:
        return
    top = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="sieveyard-")  # the driver serves the archive from here as long as it runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{top.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, path.relative_to(top.parent))
    context.addPyFile(archive)
    ship_package.done = context.applicationId


_SCRATCH = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are removed at the end, but for those written with keep, which pass to an outer scratch, if any.

    What leaves the block must depend on kept tables alone.
    """
    levels = _SCRATCH.__dict__.setdefault("levels", [])
    levels.append([])
    try:
        yield
    finally:
        for path in levels.pop():
            hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for what runs inside; the session's own comes back afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def arrow_batches(spark: SparkSession, size: str = "16m") -> AbstractContextManager[None]:
    """Smaller Arrow batches for what runs inside: Python workers and the JVM hold a few of them each."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", size)


def released_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of what runs inside go when it ends, not when the driver's memory is next cleaned; lost ones would be computed again."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Cut lineage: write df to the shared folder as Parquet and read it back. The files survive lost executors."""
    path = new_folder(df.sparkSession, name)
    levels = _SCRATCH.__dict__.get("levels", [])[: -1 if keep else None]
    if levels:
        levels[-1].append(path)
    with released_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
