"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_roots: set[str] = set()

#: Has Spark delete the shuffle files of a query as it ends; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that go to Python at once, at most; the default of 10,000 whole texts stands twice in the JVM's direct memory and in a worker.
BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting, as in tests, gets a temporary folder of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        app = spark.sparkContext.applicationId
        if app not in _local_dirs:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            _local_dirs[app] = tempfile.mkdtemp(prefix="framewright-")
        found = "file://" + _local_dirs[app]
    return found.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _root(spark: SparkSession) -> str:
    """This application's part of the shared folder; it goes when the driver's JVM ends in good order."""
    root = f"{shared_dir(spark)}/framewright/{spark.sparkContext.applicationId}"
    if root not in _roots:
        fs, place = _hadoop(spark, root)
        fs.mkdirs(place)
        fs.deleteOnExit(place)
        _roots.add(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{_root(spark)}/{uuid.uuid4().hex}-{name}"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Writes within leave no shuffle files; a query that reads a frame again shuffles anew in any case."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Writes within send at most BATCH_ROWS rows at once to Python, or fewer if the session says so."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def append(df: DataFrame, path: str) -> None:
    """Add the rows of `df` to the table at `path`."""
    with shuffles_deleted(df.sparkSession), short_batches(df.sparkSession):
        df.write.mode("append").parquet(path)


def written(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at `path`, to be deleted by `discard`."""
    out = spark.read.schema(schema).parquet(path)
    out._framewright_path = path
    return out


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back; cuts the lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    append(df, path)
    return written(df.sparkSession, path, df.schema)


def discard(*frames: DataFrame) -> None:
    """Delete what `materialise` wrote for these very frames; for steps whose successor is written."""
    for df in frames:
        path = getattr(df, "_framewright_path", None)
        if path:
            fs, place = _hadoop(df.sparkSession, path)
            fs.delete(place, True)
