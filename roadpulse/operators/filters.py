"""Range and driver filters shared by every query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.times import moment, require_range

ALL_DRIVERS = "all"


def in_range(df: DataFrame, start, end) -> DataFrame:
    """Rows whose ``record_time`` lies in the closed range; NULL times drop out."""
    require_range(start, end)
    return df.filter(F.col("record_time").between(moment(start), moment(end)))


def for_driver(df: DataFrame, driver_id: str | None = ALL_DRIVERS) -> DataFrame:
    """Rows of one driver; ``"all"`` or None keeps every driver."""
    if driver_id is None or driver_id == ALL_DRIVERS:
        return df
    return df.filter(F.col("driverID") == F.lit(driver_id))


def in_scan_order(df: DataFrame, *columns: str) -> DataFrame:
    """Sort by ``columns``; ties keep the order the scan delivered them in.

    The tie-breaker also lets the range shuffle cut through a run of equal keys,
    so one timestamp that holds a large part of the rows is spread over tasks. Meant
    for rows straight from a scan, whose order a repeated task reproduces.
    """
    return (
        df.withColumn("_scan_order", F.monotonically_increasing_id())
        .orderBy(*columns, "_scan_order")
        .drop("_scan_order")
    )
