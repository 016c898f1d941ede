"""Expressions that turn values into what a dashboard shows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.functions.times import clock_label, day_label

# Point colours.
OVERSPEED_COLOUR = "#ff0000"
NORMAL_COLOUR = "#00ff51"


def is_true(flag: Column) -> Column:
    """Strict truth: NULL counts as false."""
    return F.coalesce(flag, F.lit(False))


def number_or_zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def text_or_dash(value: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("-"))


def point_colour(overspeed: Column) -> Column:
    return F.when(overspeed, OVERSPEED_COLOUR).otherwise(NORMAL_COLOUR)


def window_title(driver: Column, start: Column, end: Column) -> Column:
    return F.concat_ws(
        " - ",
        F.concat(F.lit("Driver "), driver),
        day_label(start),
        clock_label(start),
        clock_label(end),
    )


def speeding_alert(driver: Column) -> Column:
    return F.concat(F.lit("Driver "), driver, F.lit(" is SPEEDING!"))
