"""Hand-made telemetry frames."""

from datetime import datetime

from roadpulse.schema import TELEMETRY_COLUMNS, TELEMETRY_SCHEMA


def records(spark, *rows: dict):
    """Records from partial dicts; columns not given are NULL."""
    data = [tuple(row.get(name) for name in TELEMETRY_COLUMNS) for row in rows]
    return spark.createDataFrame(data, TELEMETRY_SCHEMA)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def tuples(df):
    return [tuple(row) for row in df.collect()]
