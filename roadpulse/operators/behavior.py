"""Driver list and dangerous-behaviour summary."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.display import text_or_dash
from roadpulse.schema import DURATION_TOTALS, FLAG_COUNTS, SUMMARY_KEYS, SUMMARY_NUMBERS


def drivers_in_range(df: DataFrame) -> DataFrame:
    """Distinct drivers, ascending."""
    return df.select("driverID").distinct().orderBy("driverID")


def behavior_summary(df: DataFrame) -> DataFrame:
    """Event counts and total durations per driver and plate.

    Every aggregate combines on the map side, so a driver holding a large share
    of the rows costs one row per task in the shuffle.
    """
    counts = [F.count_if(F.col(flag)).alias(name) for flag, name in FLAG_COUNTS.items()]
    totals = [
        F.coalesce(F.sum(source), F.lit(0)).alias(name) for source, name in DURATION_TOTALS.items()
    ]
    danger = reduce(add, [F.col(name) for name in FLAG_COUNTS.values()])
    return (
        df.groupBy(*SUMMARY_KEYS)
        .agg(*counts, *totals)
        .withColumn("count_dangerEvent", danger)
        .select(*SUMMARY_KEYS, *SUMMARY_NUMBERS)
    )


def summary_display(summary: DataFrame) -> DataFrame:
    """Summary rows as shown in a table: empty driver or plate becomes ``-``."""
    return summary.withColumns({key: text_or_dash(F.col(key)) for key in SUMMARY_KEYS})


def summary_json(summary: DataFrame) -> DataFrame:
    """One JSON object per summary row, NULL keys written as null."""
    row = F.to_json(F.struct(*summary.columns), {"ignoreNullFields": "false"})
    return summary.select(row.alias("json"))
