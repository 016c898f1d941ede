"""Upload lines to typed telemetry records, with the reasons a line is rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    TimestampType,
)

from roadpulse.functions.times import month_key
from roadpulse.schema import TELEMETRY_COLUMNS, TELEMETRY_FIELDS

# What counts as white space at the ends of a line.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spark's casts alone would also take "22.5d", "NaN" or a bare year.
DECIMAL_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
DATE_TIME_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{0,6})?)?)?\s*$"

# Text that stays as written: an empty driver or plate is not missing.
KEPT_EMPTY = {"driverID", "carPlateNumber"}
# Numbers without a default: an empty field is NULL, not zero.
NO_DEFAULT = {"speed", "direction", "count_dangerEvent"}


def _computed_once(column: Column) -> Column:
    """The column as the output of a generator.

    Filters move below projections, taking a copy of every expression they use
    with them; nothing moves below a generator.
    """
    return F.explode(F.array(column))


def split_fields(lines: DataFrame) -> DataFrame:
    """Lines stripped and cut at every comma into ``fields``; blank lines dropped."""
    passed = [c for c in lines.columns if c != "value"]
    stripped = F.btrim(F.col("value"), F.lit(WHITE_SPACE))
    return (
        lines.select(*passed, _computed_once(stripped).alias("line"))
        .filter(F.col("line") != "")
        .withColumn("fields", F.split("line", ",", -1))
    )


def _field(position: int, name: str) -> str:
    text = f"get(fields, {position})"
    return text if name in KEPT_EMPTY else f"nullif({text}, '')"


def _converted(kind, text: str) -> str:
    """SQL of the typed value of a text; NULL if the text is not of that type."""
    match kind:
        case StringType():
            return text
        case DoubleType():
            return f"CASE WHEN {text} RLIKE r'{DECIMAL_TEXT}' THEN try_cast({text} AS double) END"
        case TimestampType():
            return f"CASE WHEN {text} RLIKE r'{DATE_TIME_TEXT}' THEN try_cast({text} AS timestamp) END"
        case _:
            return f"try_cast({text} AS int)"


def _finished(name: str, kind) -> str:
    """SQL of the stored value: defaults for missing ones, and flags as booleans."""
    match kind:
        case BooleanType():
            return f"coalesce({name} != 0, false)"
        case IntegerType() if name not in NO_DEFAULT:
            return f"coalesce({name}, 0)"
        case _:
            return name


def parse_telemetry(lines: DataFrame) -> DataFrame:
    """Typed records plus ``line`` and ``reject_reasons`` (empty for a good line).

    Columns of ``lines`` other than ``value`` are passed through. All work is
    built-in expressions: the text is cut once, every field is converted once.
    """
    passed = [c for c in lines.columns if c != "value"] + ["line"]
    texts = [
        f"{_field(i, name)} AS text_{name}" for i, (name, _) in enumerate(TELEMETRY_FIELDS)
    ]
    typed = [
        f"{_converted(kind, f'text_{name}')} AS {name}" for name, kind in TELEMETRY_FIELDS
    ]
    checked = [name for name, kind in TELEMETRY_FIELDS if not isinstance(kind, StringType)]
    given = [f"text_{name} IS NOT NULL AS has_{name}" for name in checked]
    stored = [f"{_finished(name, kind)} AS {name}" for name, kind in TELEMETRY_FIELDS]
    failed = [f"CASE WHEN has_{name} AND {name} IS NULL THEN '{name}' END" for name in checked]
    undecodable = "CASE WHEN NOT is_valid_utf8(line) THEN 'encoding' END"
    reasons = f"concat_ws(',', {', '.join([*failed, undecodable])}) AS reasons"
    records = (
        split_fields(lines)
        .selectExpr(*passed, *texts)
        .selectExpr(*passed, *given, *typed)
        .selectExpr(*stored, *passed, reasons)
    )
    return records.withColumn("reasons", _computed_once(F.col("reasons"))).selectExpr(
        *TELEMETRY_COLUMNS,
        *passed,
        "CASE WHEN reasons = '' THEN cast(array() AS array<string>) "
        "ELSE split(reasons, ',') END AS reject_reasons",
    )


def is_good() -> Column:
    return F.size("reject_reasons") == 0


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records, and rejected lines with their reasons."""
    good = parsed.filter(is_good()).drop("line", "reject_reasons")
    return good, parsed.filter(~is_good()).drop(*TELEMETRY_COLUMNS)


def ingest_report(parsed: DataFrame) -> DataFrame:
    """One row: lines seen, good and rejected."""
    return parsed.agg(
        F.count("*").alias("seen"),
        F.count_if(is_good()).alias("good"),
        F.count_if(~is_good()).alias("rejected"),
    )


def with_shard(df: DataFrame, route: str = "file_name") -> DataFrame:
    """Add ``shard`` (``YYYY_MM``), from the upload's name or the record's own time."""
    if route == "file_name":
        return df.withColumn("shard", F.substring("file_name", 15, 7))
    if route == "record_time":
        return df.withColumn("shard", month_key(F.col("record_time")))
    raise ValueError(f"route must be file_name or record_time, not {route!r}")
