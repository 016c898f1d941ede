"""The three questions asked of a stored telemetry table, as one call each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.operators.behavior import behavior_summary, drivers_in_range
from roadpulse.operators.filters import ALL_DRIVERS
from roadpulse.operators.speed import speed_series
from roadpulse.schema import SPEED_INPUT, SUMMARY_INPUT
from roadpulse.sources.table import read_telemetry


def active_drivers(spark: SparkSession, table: str, start, end) -> DataFrame:
    """Drivers with a record in the closed range, ascending."""
    return drivers_in_range(read_telemetry(spark, table, start, end, columns=["driverID"]))


def driving_behavior(
    spark: SparkSession, table: str, start, end, driver_id: str | None = ALL_DRIVERS
) -> DataFrame:
    """Dangerous-behaviour summary per driver and plate."""
    records = read_telemetry(spark, table, start, end, driver_id, SUMMARY_INPUT)
    return behavior_summary(records)


def speed_data(spark: SparkSession, table: str, start, end, driver_id: str) -> DataFrame:
    """Speed samples of a driver (or ``"all"``), ascending by time."""
    if not driver_id:
        raise ValueError("driver_id is required")
    return speed_series(read_telemetry(spark, table, start, end, driver_id, SPEED_INPUT))
