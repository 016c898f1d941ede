"""Time strings, range bounds, month shards and display labels."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

TABLE_PREFIX = "detail_record_"


def normalize_ts(value: Column) -> Column:
    """``T`` becomes a blank and a minute-precision time gains ``:00``."""
    spaced = F.replace(value, F.lit("T"), F.lit(" "))
    minute_precision = (F.length(spaced) == 16) & (F.substring(spaced, 11, 1) == " ")
    return F.when(minute_precision, F.concat(spaced, F.lit(":00"))).otherwise(spaced)


def parse_bound(value: str | datetime, name: str = "time") -> datetime:
    """A range bound given as text or datetime, as a zone-less datetime."""
    if value is None or value == "":
        raise ValueError(f"{name} is required")
    try:
        moment = value if isinstance(value, datetime) else datetime.fromisoformat(value.strip())
    except (ValueError, AttributeError) as exc:
        raise ValueError(f"{name} is not a date or time: {value!r}") from exc
    if moment.tzinfo is not None:
        raise ValueError(f"{name} must not carry a zone: {value!r}")
    return moment


def require_range(start, end) -> tuple[datetime, datetime]:
    return parse_bound(start, "start"), parse_bound(end, "end")


def moment(value: str | datetime) -> Column:
    """A bound as a timestamp literal (folded to a constant by Catalyst)."""
    return F.lit(parse_bound(value).isoformat(sep=" ")).cast("timestamp")


def month_key(time: Column) -> Column:
    """``YYYY_MM`` of a date or timestamp."""
    return F.date_format(time, "yyyy_MM")


def shard_keys(start, end) -> list[str]:
    """Month keys ``YYYY_MM`` touched by the closed range, oldest first."""
    first, last = require_range(start, end)
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [f"{m // 12:04d}_{m % 12 + 1:02d}" for m in months]


def month_span(key: str) -> tuple[datetime, datetime]:
    """First moment of the month ``YYYY_MM`` and of the month after it."""
    first = datetime.strptime(key, "%Y_%m")
    return first, (first + timedelta(days=31)).replace(day=1)


def shard_names(start, end) -> list[str]:
    """Names of the month tables touched by the closed range, oldest first."""
    return [TABLE_PREFIX + key for key in shard_keys(start, end)]


def shard_months(start: Column, end: Column) -> Column:
    """Array of the first days of the months in a range held in columns; empty if reversed."""
    first, last = F.trunc(start, "month"), F.trunc(end, "month")
    months = F.sequence(first, last, F.make_ym_interval(F.lit(0), F.lit(1)))
    return F.when(first <= last, months).otherwise(F.array().cast("array<date>"))


def shard_name(month: Column) -> Column:
    """Name of the month table of a date or timestamp."""
    return F.concat(F.lit(TABLE_PREFIX), month_key(month))


def default_range(now: datetime) -> tuple[str, str]:
    """The last seven days up to ``now`` (UTC), to the minute."""
    return tuple(
        t.isoformat(timespec="minutes") for t in (now - timedelta(days=7), now)
    )


def day_label(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd")


def clock_label(time: Column) -> Column:
    return F.date_format(time, "hh:mm:ss a")
