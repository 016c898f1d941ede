"""Positions of rows inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.session import written


def with_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with ``position``, counted from 0 in the order of ``order`` within rows of equal ``keys``.

    All rows are sorted once over many tasks, ties cut by scan position, so a group with most of the rows is
    spread like any other. A task counts the rows of each group it holds; what the tasks before it hold of
    the same group is added. No group is gathered, and groups of every size take the same way. NULL keys are a
    group of their own. Meant for rows straight from a scan, whose order a repeated task reproduces.
    """
    sorting = [*keys, *order, "_scan"]
    placed = (
        df.withColumn("_scan", F.monotonically_increasing_id())
        .repartitionByRange(*sorting)
        .sortWithinPartitions(*sorting)
        .withColumns({"_task": F.spark_partition_id(), "_row": F.monotonically_increasing_id()})
    )
    # Written, so that tasks and rows keep their numbers whatever is computed again.
    rows = written(placed.drop("_scan"), "positions")
    held = rows.groupBy(*keys, "_task").agg(F.min("_row").alias("_first"), F.count("*").alias("_held"))
    # A group has at most one row here for each task.
    earlier = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_held").over(earlier), F.lit(0))
    starts = held.select(
        *[F.col(c).alias(f"_at_{c}") for c in [*keys, "_task"]], (before - F.col("_first")).alias("_offset")
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in [*keys, "_task"]])
    position = (F.col("_row") + F.col("_offset")).alias("position")
    return rows.join(starts, same).select(*df.columns, position)
