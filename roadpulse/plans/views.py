"""Telemetry records derived from the given ``events`` and ``orders`` tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, TimestampType

from roadpulse.functions.times import parse_bound
from roadpulse.schema import TELEMETRY_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def naive_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables store them."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def events_between(events: DataFrame, start, end) -> DataFrame:
    """Events whose second lies in the closed range, told on the raw ``ts`` column.

    The test on the truncated ``record_time`` stays with the caller; this one is
    what the scan can use.
    """
    first = parse_bound(start).replace(microsecond=0)
    after = parse_bound(end).replace(microsecond=0) + timedelta(seconds=1)
    bounds = [F.lit(str(t)).cast("timestamp_ntz") for t in (first, after)]
    return events.filter((F.col("ts") >= bounds[0]) & (F.col("ts") < bounds[1]))


_EVENT_RECORD = {
    "driverID": "'driver' || lpad(user_id, 7, '0')",
    "carPlateNumber": "'PL' || event_id % 2 || '-' || user_id",
    "latitude": "22 + k / 128D",
    "longitude": "113 + k / 64D",
    "speed": "nullif(cast(floor(value) AS int), 13)",
    "direction": "k * 37 % 360",
    "siteName": "CASE WHEN k % 4 > 0 THEN 'site' || k % 4 END",
    "record_time": "date_trunc('second', cast(ts AS timestamp))",
    "isRapidlySpeedup": "event_type = 'click'",
    "isRapidlySlowdown": "event_type = 'view'",
    "isNeutralSlide": "event_type = 'purchase'",
    "isNeutralSlideFinished": "event_type = 'purchase' AND k % 2 = 0",
    "neutralSlideTime": "CASE WHEN event_type = 'purchase' THEN k END",
    "isOverspeed": "value >= 100",
    "isOverspeedFinished": "value >= 100 AND k % 2 = 1",
    "overspeedTime": "CASE WHEN value >= 100 THEN k END",
    "isFatigueDriving": "event_type = 'error'",
    "isHthrottleStop": "event_type = 'signup'",
    "isOilLeak": "k % 10 = 0",
    "count_dangerEvent": "CASE WHEN k % 3 = 0 THEN k % 7 END",
}

# An order's date moved to a second of the day that depends on its key.
ORDER_TIME = (
    "cast(o_orderdate + make_dt_interval(0, 0, 0, o_orderkey * 7919 % 86400) AS timestamp)"
)

_ORDER_RECORD = {
    "driverID": "'driver' || lpad(o_custkey, 7, '0')",
    "carPlateNumber": "CASE WHEN o_orderkey % 3 > 0 THEN 'OR-' || o_orderkey % 3 END",
    "latitude": "22 + o_orderkey % 100 / 128D",
    "longitude": "113 + o_orderkey % 90 / 64D",
    "speed": "speed",
    "direction": "cast(o_orderkey % 360 AS int)",
    "siteName": "cast(NULL AS string)",
    "record_time": ORDER_TIME,
    "isRapidlySpeedup": "priority = 1",
    "isRapidlySlowdown": "priority = 2",
    "isNeutralSlide": "priority = 3",
    "isNeutralSlideFinished": "priority = 3 AND o_orderstatus = 'F'",
    "neutralSlideTime": "CASE WHEN priority = 3 THEN cast(o_orderkey % 240 AS int) END",
    "isOverspeed": "speed > 120",
    "isOverspeedFinished": "speed > 120 AND o_orderstatus = 'F'",
    "overspeedTime": "CASE WHEN speed > 120 THEN cast(o_orderkey % 240 AS int) END",
    "isFatigueDriving": "priority = 4",
    "isHthrottleStop": "priority = 5",
    "isOilLeak": "o_orderkey % 50 = 0",
    "count_dangerEvent": "cast(NULL AS int)",
}


def _records(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expressions[name]} AS {name}" for name in TELEMETRY_COLUMNS])


def events_telemetry(events: DataFrame) -> DataFrame:
    """One record per event: two plates per user, times to the second."""
    number = "cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k"
    return _records(events.selectExpr("*", number), _EVENT_RECORD)


def orders_telemetry(orders: DataFrame) -> DataFrame:
    """One record per order: many months, three plates per customer."""
    priority = "cast(left(o_orderpriority, 1) AS int) AS priority"
    speed = "cast(floor(o_totalprice / 3000) AS int) AS speed"
    return _records(orders.selectExpr("*", priority, speed), _ORDER_RECORD)


def upload_line(records: DataFrame) -> Column:
    """A record as an upload line: empty text for NULL, 1 or empty for a flag."""
    texts = []
    for field in records.schema.fields:
        match field.dataType:
            case BooleanType():
                text = f"CASE WHEN {field.name} THEN '1' END"
            case TimestampType():
                text = f"date_format({field.name}, 'yyyy-MM-dd HH:mm:ss')"
            case _:
                text = f"cast({field.name} AS string)"
        texts.append(f"coalesce({text}, '')")
    return F.expr(f"concat_ws(',', {', '.join(texts)})")
