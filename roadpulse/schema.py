"""Column layout of telemetry records, the stored table and the query results."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The 20 positional fields of an upload line, in file order, with
# the type each one is parsed to.
TELEMETRY_FIELDS = [
    ("driverID", StringType()),
    ("carPlateNumber", StringType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("speed", IntegerType()),
    ("direction", IntegerType()),
    ("siteName", StringType()),
    ("record_time", TimestampType()),
    ("isRapidlySpeedup", BooleanType()),
    ("isRapidlySlowdown", BooleanType()),
    ("isNeutralSlide", BooleanType()),
    ("isNeutralSlideFinished", BooleanType()),
    ("neutralSlideTime", IntegerType()),
    ("isOverspeed", BooleanType()),
    ("isOverspeedFinished", BooleanType()),
    ("overspeedTime", IntegerType()),
    ("isFatigueDriving", BooleanType()),
    ("isHthrottleStop", BooleanType()),
    ("isOilLeak", BooleanType()),
    ("count_dangerEvent", IntegerType()),
]

TELEMETRY_SCHEMA = StructType([StructField(n, t, True) for n, t in TELEMETRY_FIELDS])
TELEMETRY_COLUMNS = TELEMETRY_SCHEMA.fieldNames()

# The stored table adds its two partition columns: the month a record belongs to
# and the load that wrote it (a load run again replaces what it wrote before).
TABLE_SCHEMA = StructType(
    TELEMETRY_SCHEMA.fields
    + [StructField("shard", StringType(), True), StructField("load_id", StringType(), True)]
)

# Flag column -> name of its count in the behaviour summary.
FLAG_COUNTS = {
    "isOverspeed": "count_overspeed",
    "isFatigueDriving": "count_fatigueDriving",
    "isNeutralSlide": "count_neutralSlide",
    "isRapidlySpeedup": "count_rapidSpeedUp",
    "isRapidlySlowdown": "count_rapidSlowDown",
    "isHthrottleStop": "count_hthrottleStop",
    "isOilLeak": "count_oilLeak",
}

# Duration column -> name of its total in the behaviour summary.
DURATION_TOTALS = {
    "overspeedTime": "time_overspeed",
    "neutralSlideTime": "time_neutralSlide",
}

SUMMARY_KEYS = ["driverID", "carPlateNumber"]

# Order of the ten numbers in a summary row.
SUMMARY_NUMBERS = [
    "count_overspeed",
    "time_overspeed",
    "count_fatigueDriving",
    "count_neutralSlide",
    "time_neutralSlide",
    "count_rapidSpeedUp",
    "count_rapidSlowDown",
    "count_hthrottleStop",
    "count_oilLeak",
    "count_dangerEvent",
]

SUMMARY_SCHEMA = StructType(
    [StructField(k, StringType(), True) for k in SUMMARY_KEYS]
    + [StructField(n, LongType(), True) for n in SUMMARY_NUMBERS]
)

# What the behaviour summary needs from a scan, besides the time filter column.
SUMMARY_INPUT = SUMMARY_KEYS + ["record_time", *FLAG_COUNTS, *DURATION_TOTALS]
SPEED_INPUT = ["driverID", "record_time", "speed", "isOverspeed"]
