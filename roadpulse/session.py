"""Session helpers: the shared scratch folder and the Parquet time encoding."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SHARED_FOLDER = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TIME_ENCODING = "spark.sql.parquet.outputTimestampType"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _application_folder(spark: SparkSession) -> str:
    base = spark.conf.get(_SHARED_FOLDER, None) or spark.conf.get(_WAREHOUSE)
    local = spark.sparkContext.master.startswith("local")
    if not local and not spark.conf.get(_SHARED_FOLDER, None) and base.startswith(("file:", "/")):
        raise ValueError(f"set {_SHARED_FOLDER} to a folder that all executors see")
    return f"{base.rstrip('/')}/roadpulse/{spark.sparkContext.applicationId}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder path for written intermediates, on storage every executor sees.

    It lies under the folder the session names in ``spark.checkpoint.dir``, or else in
    its warehouse. ``clear_scratch`` removes all of them; so does the driver's end.
    """
    folder = _application_folder(spark)
    if folder not in _registered:
        _registered.add(folder)
        atexit.register(clear_scratch, spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


_registered: set[str] = set()


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as its own type."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove_folder(spark: SparkSession, path: str) -> None:
    files, folder = file_system(spark, path)
    files.delete(folder, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove every written intermediate of this application.

    Results that were not yet computed or stored still need theirs.
    """
    if spark.sparkContext._jsc is not None:
        remove_folder(spark, _application_folder(spark))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, computed once and read back from a new shared folder."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of queries that end within, instead of when the driver's memory is cleaned."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


@contextmanager
def small_arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Hand rows to Arrow maps of queries that run within in batches of about ``most`` bytes, instead of 64 MB."""
    before = spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(ARROW_BYTES, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_BYTES)
        else:
            spark.conf.set(ARROW_BYTES, before)


@contextmanager
def prunable_times(spark: SparkSession) -> Iterator[None]:
    """Write timestamps as 64-bit microseconds, whose footers a time filter can use."""
    before = spark.conf.get(TIME_ENCODING)
    spark.conf.set(TIME_ENCODING, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(TIME_ENCODING, before)
