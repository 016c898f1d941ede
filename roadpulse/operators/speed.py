"""Speed series and the fixed-length windows laid over a queried range."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.display import (
    is_true,
    number_or_zero,
    point_colour,
    speeding_alert,
    window_title,
)
from roadpulse.functions.times import clock_label, moment, require_range
from roadpulse.operators.filters import in_range, in_scan_order
from roadpulse.operators.positions import with_positions
from roadpulse.schema import SPEED_INPUT

WINDOW_MINUTES = 3
# Fixed value: how times are written in JSON (they are UTC by convention).
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
WINDOW_KEYS = ["driverID", "window_index"]


def speed_series(df: DataFrame) -> DataFrame:
    """Speed samples ascending by time."""
    return in_scan_order(df.select(*SPEED_INPUT), "record_time")


def speed_series_json(df: DataFrame) -> DataFrame:
    """One JSON object per sample, ascending by time; NULL fields are left out."""
    fields = F.struct("record_time", "speed", "isOverspeed")
    sample = F.to_json(fields, {"timestampFormat": JSON_TIME})
    return speed_series(df).select(sample.alias("json"))


def speed_points(df: DataFrame) -> DataFrame:
    """Samples ready to draw: NULL speed is 0, NULL flag is false, no NULL times."""
    timed = df.filter(F.col("record_time").isNotNull())
    overspeed = is_true(F.col("isOverspeed"))
    return timed.select(
        "driverID",
        "record_time",
        number_or_zero(F.col("speed")).alias("speed"),
        overspeed.alias("isOverspeed"),
        clock_label(F.col("record_time")).alias("label"),
        point_colour(overspeed).alias("colour"),
    )


def _in_windows(df: DataFrame, start, end, minutes: int) -> DataFrame:
    """Rows of the range with their ``window_index``, counted from ``start``.

    Windows start strictly before ``end``: when the range is a whole number of
    windows, a sample exactly at ``end`` belongs to none of them.
    """
    first, last = require_range(start, end)
    ranged = in_range(df, start, end)
    if (last - first) % timedelta(minutes=minutes) == timedelta(0):
        ranged = ranged.filter(F.col("record_time") < moment(end))
    anchor = f"unix_micros(timestamp '{first.isoformat(sep=' ')}')"
    index = F.expr(f"(unix_micros(record_time) - {anchor}) div {_micros(minutes)}")
    return ranged.withColumn("window_index", index)


def _micros(minutes: int) -> int:
    return timedelta(minutes=minutes) // timedelta(microseconds=1)


def _window_edge(start, index: Column, minutes: int) -> Column:
    return F.timestamp_micros(F.unix_micros(moment(start)) + index * F.lit(_micros(minutes)))


def _with_edges(windows: DataFrame, start, minutes: int) -> DataFrame:
    index = F.col("window_index")
    return windows.withColumns(
        {
            "window_start": _window_edge(start, index, minutes),
            "window_end": _window_edge(start, index + 1, minutes),
        }
    )


def speed_windows(df: DataFrame, start, end, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Non-empty windows per driver with size, top speed and an overspeed flag."""
    windows = (
        _in_windows(df, start, end, minutes)
        .groupBy(*WINDOW_KEYS)
        .agg(
            F.count("*").alias("n_points"),
            F.coalesce(F.max("speed"), F.lit(0)).alias("max_speed"),
            F.bool_or(is_true(F.col("isOverspeed"))).alias("is_overspeed"),
        )
    )
    title = window_title(F.col("driverID"), F.col("window_start"), F.col("window_end"))
    return _with_edges(windows, start, minutes).select(
        *WINDOW_KEYS,
        "window_start",
        "window_end",
        "n_points",
        "max_speed",
        "is_overspeed",
        title.alias("title"),
    )


def overspeed_alerts(df: DataFrame, start, end, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Windows holding at least one overspeed sample, with the alert text.

    Only overspeed samples can raise an alert, so the flag is tested before the
    aggregation and reaches the scan.
    """
    windows = (
        _in_windows(df.filter(F.col("isOverspeed")), start, end, minutes)
        .groupBy(*WINDOW_KEYS)
        .agg(F.count("*").alias("n_overspeed"))
    )
    return _with_edges(windows, start, minutes).select(
        *WINDOW_KEYS,
        "window_start",
        "window_end",
        "n_overspeed",
        speeding_alert(F.col("driverID")).alias("alert"),
    )


def window_points(df: DataFrame, start, end, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Drawable samples with their window, ordered by driver, window and time.

    The relational form of a window's label, speed and colour lists: no group is
    ever gathered, so its size does not matter. Only raw values are sorted; texts
    are made afterwards.
    """
    indexed = _in_windows(df.select(*SPEED_INPUT), start, end, minutes)
    ordered = in_scan_order(indexed, "driverID", "record_time")
    return ordered.select(
        *WINDOW_KEYS,
        "record_time",
        clock_label(F.col("record_time")).alias("label"),
        number_or_zero(F.col("speed")).alias("speed"),
        point_colour(is_true(F.col("isOverspeed"))).alias("colour"),
    )


def window_lists(
    df: DataFrame,
    start,
    end,
    minutes: int = WINDOW_MINUTES,
    max_points: int = 20_000,
) -> DataFrame:
    """Ordered label, speed and colour lists of every driver and window, in parts.

    Samples are ordered by time, speed and flag. Sample i of a window (from 0) is in ``part`` i div
    ``max_points``, whatever the window's size: every part but a window's last holds ``max_points``
    samples, and the parts in order are the window. No task holds more than a part at once.
    """
    samples = _in_windows(df.select(*SPEED_INPUT), start, end, minutes).select(
        *WINDOW_KEYS,
        "record_time",
        number_or_zero(F.col("speed")).alias("speed"),
        is_true(F.col("isOverspeed")).alias("isOverspeed"),
    )
    placed = with_positions(samples, WINDOW_KEYS, ["record_time", "speed", "isOverspeed"])
    parted = placed.withColumn("part", F.expr(f"position div {int(max_points)}"))
    point = F.struct("position", "record_time", "speed", "isOverspeed")
    gathered = parted.groupBy(*WINDOW_KEYS, "part").agg(
        F.sort_array(F.collect_list(point)).alias("points")
    )
    return gathered.select(
        *WINDOW_KEYS,
        "part",
        F.transform("points", lambda p: clock_label(p["record_time"])).alias("labels"),
        F.col("points.speed").alias("speeds"),
        F.transform("points", lambda p: point_colour(p["isOverspeed"])).alias("colours"),
    )

