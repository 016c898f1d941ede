"""Folding the many loads of a month into few files, clustered by driver and time."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from roadpulse.schema import TELEMETRY_COLUMNS
from roadpulse.session import prunable_times, remove_folder
from roadpulse.sources.manifest import folded_loads, newest_manifests, open_loads, publish, snapshot_folder
from roadpulse.sources.table import read_month

ROWS_PER_FILE = 2_000_000


@dataclass(frozen=True)
class Folded:
    """A month that was folded: loads that joined its snapshot, rows and files of the snapshot."""

    month: str
    loads: int
    rows: int
    files: int


def compact_month(
    spark: SparkSession, path: str, month: str, rows_per_file: int = ROWS_PER_FILE
) -> Folded | None:
    """Write a month (``YYYY_MM``) of the table anew as files of about ``rows_per_file`` rows, and switch to them.

    Files hold ranges of driver and time, so a query for one driver opens few of them; a driver with most of the
    rows is cut by time over many files. The rows of the new files are counted before the switch, which is one rename.
    Loads that arrive meanwhile stay beside the snapshot and join the next. A load that is repeated after it was
    folded changes nothing. Returns None if no load is waiting, or if another fold came first; its files
    are then removed again. ``remove_replaced`` removes the old folders.
    """
    version = newest_manifests(spark, path, [month]).get(month, 0)
    known = folded_loads(spark, path, {month: version} if version else {})
    waiting = open_loads(spark, path, [month], known)
    if not waiting:
        return None
    rows = read_month(spark, path, month, version, list(waiting)).drop("shard")
    expected = rows.count()
    files = max(1, -(-expected // rows_per_file))
    clustering = ["driverID", "record_time", "_scan"]
    clustered = (
        rows.withColumn("_scan", F.monotonically_increasing_id())
        .repartitionByRange(files, *clustering)
        .sortWithinPartitions(*clustering)
        .drop("_scan")
    )
    target = snapshot_folder(path, month, f"{version + 1}-{uuid.uuid4().hex}")
    with prunable_times(spark):
        clustered.write.option("parquet.bloom.filter.enabled#driverID", "true").parquet(target)
    bounds = (
        spark.read.schema(rows.schema).parquet(target)
        .groupBy(F.col("_metadata.file_path").alias("file_path"))
        .agg(
            F.min("driverID").alias("driver_low"), F.max("driverID").alias("driver_high"),
            F.min("record_time").alias("time_low"), F.max("record_time").alias("time_high"),
            F.count("*").alias("n_rows"),
        )
        .coalesce(1)
        .cache()
    )
    try:
        stored, n_files = bounds.agg(F.coalesce(F.sum("n_rows"), F.lit(0)), F.count("*")).first()
        if stored != expected:
            raise RuntimeError(f"{target} holds {stored} rows, {expected} were read")
        loads = sorted({load_id for _, load_id in known} | set(waiting.values()))
        if not publish(spark, path, month, version, bounds, loads):
            remove_folder(spark, target)
            return None
    finally:
        bounds.unpersist()
    return Folded(month, len(waiting), stored, n_files)
