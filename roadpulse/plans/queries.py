"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.times import TABLE_PREFIX, normalize_ts, shard_keys, shard_months, shard_name
from roadpulse.operators.behavior import (
    behavior_summary,
    drivers_in_range,
    summary_display,
    summary_json,
)
from roadpulse.operators import load
from roadpulse.operators.compact import compact_month
from roadpulse.operators.filters import for_driver, in_range
from roadpulse.operators.load import append_telemetry, load_folder, load_log, table_path
from roadpulse.operators.parse import (
    ingest_report,
    parse_telemetry,
    split_rejects,
    with_shard,
)
from roadpulse.operators.speed import (
    overspeed_alerts,
    speed_points,
    speed_series,
    speed_series_json,
    speed_windows,
    window_lists,
    window_points,
)
from roadpulse.plans.reports import active_drivers, driving_behavior, speed_data
from roadpulse.plans.views import (
    ORDER_TIME,
    events_between,
    events_telemetry,
    naive_times,
    orders_telemetry,
    table,
    upload_line,
)
from roadpulse.schema import SPEED_INPUT, TABLE_SCHEMA, TELEMETRY_COLUMNS
from roadpulse.session import scratch_folder
from roadpulse.sources.files import admit_files, drop_seen_files
from roadpulse.sources.jdbc import append_jdbc, append_jdbc_once, read_jdbc_shard, read_jdbc_telemetry
from roadpulse.sources.manifest import remove_replaced
from roadpulse.sources.table import (
    read_shards,
    read_telemetry,
    shard_row_counts,
    union_shards,
)
from roadpulse.streaming.ingest import ingest_stream
from roadpulse.streaming.monitor import latest_windows, monitor_stream, start_monitor
from roadpulse.streaming.store import start_window_store, stored_windows

Query = Callable[[SparkSession, str], DataFrame]

# A range around all the data, starting off the 3-minute grid of the epoch.
WHOLE = ("1990-01-01T00:01", "2100-01-01T00:00")
# Part of January 2024, and six months of orders across a year's end.
JANUARY = ("2024-01-03T08:00", "2024-01-20T17:30")
HALF_YEAR = ("1996-10-05T06:00", "1997-03-20T18:30")
DRIVER = "driver0000013"


def _events(spark: SparkSession, sf_dir: str, period=WHOLE) -> DataFrame:
    events = events_between(table(spark, sf_dir, "events"), *period)
    return in_range(events_telemetry(events), *period)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_telemetry(table(spark, sf_dir, "orders"))


# --- behaviour summary and drivers -------------------------------------------


def behavior_summary_all(spark, sf_dir):
    return behavior_summary(_events(spark, sf_dir))


def behavior_summary_range(spark, sf_dir):
    return behavior_summary(_events(spark, sf_dir, JANUARY))


def behavior_summary_driver(spark, sf_dir):
    return behavior_summary(for_driver(_events(spark, sf_dir), DRIVER))


def behavior_summary_display(spark, sf_dir):
    return summary_display(behavior_summary(_orders(spark, sf_dir)))


def behavior_summary_json(spark, sf_dir):
    return summary_json(behavior_summary(_orders(spark, sf_dir)))


def drivers_active(spark, sf_dir):
    return drivers_in_range(_events(spark, sf_dir, JANUARY))


# --- speed -------------------------------------------------------------------


def speed_series_all(spark, sf_dir):
    return naive_times(speed_series(_events(spark, sf_dir)))


def speed_series_driver(spark, sf_dir):
    return naive_times(speed_series(for_driver(_events(spark, sf_dir, JANUARY), DRIVER)))


def speed_series_as_json(spark, sf_dir):
    return speed_series_json(for_driver(_events(spark, sf_dir), DRIVER))


def speed_series_json_all(spark, sf_dir):
    """The series of every driver as JSON."""
    return speed_series_json(_events(spark, sf_dir))


def speed_points_clean(spark, sf_dir):
    return naive_times(speed_points(_events(spark, sf_dir)))


def speed_windows_3min(spark, sf_dir):
    return naive_times(speed_windows(_events(spark, sf_dir), *WHOLE))


def speed_windows_driver(spark, sf_dir):
    records = for_driver(_events(spark, sf_dir, JANUARY), DRIVER)
    return naive_times(speed_windows(records, *JANUARY))


def overspeed_window_alerts(spark, sf_dir):
    return naive_times(overspeed_alerts(_events(spark, sf_dir), *WHOLE))


def window_points_3min(spark, sf_dir):
    return naive_times(window_points(_events(spark, sf_dir), *WHOLE))


def window_lists_daily(spark, sf_dir):
    """Day-long windows, so that lists hold several points; lists shown as text."""
    lists = window_lists(_events(spark, sf_dir), *WHOLE, minutes=1440)
    speeds = F.transform("speeds", lambda s: s.cast("int").cast("string"))
    return lists.select(
        "driverID",
        "window_index",
        "part",
        F.array_join("labels", ",").alias("labels"),
        F.array_join(speeds, ",").alias("speeds"),
        F.array_join("colours", ",").alias("colours"),
    )


def window_lists_parts(spark, sf_dir):
    """Windows of 400 days in parts of 16 samples; lists shown as text."""
    lists = window_lists(_events(spark, sf_dir), *WHOLE, minutes=400 * 1440, max_points=16)
    speeds = F.transform("speeds", lambda s: s.cast("int").cast("string"))
    return lists.select(
        "driverID",
        "window_index",
        "part",
        F.array_join("labels", ",").alias("labels"),
        F.array_join(speeds, ",").alias("speeds"),
        F.array_join("colours", ",").alias("colours"),
    )


# --- month shards ------------------------------------------------------------


def month_shards_range(spark, sf_dir):
    """Month tables touched by each customer's first-to-last order."""
    spans = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("first"),
        F.max("o_orderdate").cast("date").alias("last"),
    )
    months = F.explode(shard_months(F.col("first"), F.col("last")))
    named = shard_name(F.col("month")).alias("shard_table")
    return spans.select("o_custkey", months.alias("month")).select("o_custkey", named)


def month_row_counts(spark, sf_dir):
    return shard_row_counts(with_shard(_orders(spark, sf_dir), route="record_time"))


_written_tables: dict[tuple[str, str], str] = {}


def _orders_table(spark: SparkSession, sf_dir: str) -> str:
    """The orders as a stored month table, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written_tables:
        path = scratch_folder(spark, "orders-table")
        records = with_shard(_orders(spark, sf_dir), route="record_time")
        append_telemetry(records, path, "orders", gather=True)
        _written_tables[key] = path
    return _written_tables[key]


def multi_shard_records(spark, sf_dir):
    """All columns of a half-year range over a year's end."""
    return naive_times(read_telemetry(spark, _orders_table(spark, sf_dir), *HALF_YEAR))


def multi_shard_summary(spark, sf_dir):
    return driving_behavior(spark, _orders_table(spark, sf_dir), *HALF_YEAR)


def multi_shard_drivers(spark, sf_dir):
    return active_drivers(spark, _orders_table(spark, sf_dir), *HALF_YEAR)


def multi_shard_speed(spark, sf_dir):
    series = speed_data(spark, _orders_table(spark, sf_dir), *HALF_YEAR, DRIVER)
    return naive_times(series)


def shards_with_missing_month(spark, sf_dir):
    """One reader per month folder, the last of which does not exist."""
    path = _orders_table(spark, sf_dir)
    months = ["1996_12", "1997_01", "1997_02", "2030_01"]
    readers = {
        month: lambda month=month: spark.read.parquet(f"{path}/shard={month}") for month in months
    }
    return naive_times(read_shards(spark, readers).select(*SPEED_INPUT))


def every_shard_and_missing(spark, sf_dir):
    """One reader for every month from before the first order to after the last; some do not exist."""
    path = _orders_table(spark, sf_dir)
    edges = table(spark, sf_dir, "orders").selectExpr(
        "date_format(add_months(min(o_orderdate), -2), 'yyyy-MM-dd') AS lo",
        "date_format(add_months(max(o_orderdate), 2), 'yyyy-MM-dd') AS hi",
    ).first()
    if edges.lo is None:
        return naive_times(read_shards(spark, {}).select(*SPEED_INPUT))
    readers = {
        month: lambda month=month: spark.read.schema(TABLE_SCHEMA).parquet(f"{path}/shard={month}")
        for month in shard_keys(edges.lo, edges.hi)
    }
    return naive_times(read_shards(spark, readers).select(*SPEED_INPUT))


def union_missing_columns(spark, sf_dir):
    events = _events(spark, sf_dir).select("driverID", "record_time", "speed")
    orders = _orders(spark, sf_dir).select("driverID", "record_time", "isOverspeed")
    return naive_times(union_shards([events, orders]))


def normalized_times(spark, sf_dir):
    """Order times written with and without seconds, with ``T`` or a blank, or empty."""
    key, time = F.col("o_orderkey"), F.expr(ORDER_TIME)
    raw = (
        F.when(key % 5 == 0, F.date_format(time, "yyyy-MM-dd'T'HH:mm"))
        .when(key % 5 == 1, F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(key % 5 == 2, F.date_format(time, "yyyy-MM-dd HH:mm"))
        .when(key % 5 == 3, F.lit(""))
    )
    written = table(spark, sf_dir, "orders").withColumn("raw_time", raw)
    return written.select(
        "o_orderkey", "raw_time", normalize_ts(F.col("raw_time")).alias("normal_time")
    )


# --- uploads -----------------------------------------------------------------


def _upload_names(orders: DataFrame) -> DataFrame:
    """A file name and size per order: well-formed ones and one defect of each kind."""
    key = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy_MM_dd")
    clock = F.format_string("_%02d_%02d_%02d", key % 24, key % 60, key % 59)
    plain = F.concat(F.lit(TABLE_PREFIX), day, clock)
    kind = key % 9
    name = (
        F.when(kind == 1, F.concat(F.upper(plain), F.lit(".TXT")))
        .when(kind == 2, plain)
        .when(kind == 3, F.format_string("detail_record_%d.csv", key))
        .when(kind == 4, F.format_string("a b%d.csv", key))
        .when(kind == 5, F.format_string("x%d.pdf", key))
        .when(kind == 7, F.concat(F.lit("detail_record_1999_99_01"), clock, F.lit(".csv")))
        .when(kind == 8, F.format_string("é%d.csv", key))
        .otherwise(F.concat(plain, F.lit(".csv")))
    )
    size = F.when(kind == 6, F.lit(104857601)).otherwise(104857600 - key)
    return orders.select(
        "o_orderkey",
        "o_orderstatus",
        name.alias("file_name"),
        size.cast("bigint").alias("file_size"),
    )


def file_admission(spark, sf_dir):
    names = _upload_names(table(spark, sf_dir, "orders"))
    return admit_files(names).drop("o_orderstatus")


def new_files_only(spark, sf_dir):
    """Files of open orders whose name did not come with a finished order."""
    names = _upload_names(table(spark, sf_dir, "orders"))
    seen = names.filter("o_orderstatus = 'F'")
    return drop_seen_files(names.filter("o_orderstatus != 'F'"), seen).drop("o_orderstatus")


def _upload_name_of_day(time: Column) -> Column:
    return F.concat(F.lit(TABLE_PREFIX), F.date_format(time, "yyyy_MM_dd"), F.lit("_00_00_00.csv"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as upload lines, one upload a day."""
    records = _events(spark, sf_dir)
    return records.select(
        upload_line(records).alias("value"),
        _upload_name_of_day(F.col("record_time")).alias("file_name"),
    )


# What is put in the place of which field, by kind of defect.
_DAMAGE = {
    1: (2, "22.5d"),
    2: (4, "6x"),
    3: (7, "not-a-time"),
    6: (15, "99999999999"),
    8: (7, "2024"),
    9: (3, "nan"),
}


def _damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as upload lines, with a defect chosen by direction."""
    records = _events(spark, sf_dir)
    lines = records.select(
        "driverID",
        upload_line(records).alias("line"),
        (F.col("direction") % 11).alias("kind"),
        _upload_name_of_day(F.col("record_time")).alias("file_name"),
    )
    positions = " ".join(f"WHEN {kind} THEN {at}" for kind, (at, _) in _DAMAGE.items())
    texts = " ".join(f"WHEN {kind} THEN '{text}'" for kind, (_, text) in _DAMAGE.items())
    value = f"""CASE
        WHEN kind = 4 THEN '  \t'
        WHEN kind = 5 THEN driverID
        WHEN kind = 7 THEN '  ' || line || ',EXTRA,MORE '
        WHEN kind IN ({', '.join(map(str, _DAMAGE))}) THEN array_join(transform(
            split(line, ','),
            (x, i) -> if(i = CASE kind {positions} END, CASE kind {texts} END, x)), ',')
        ELSE line END AS value"""
    return lines.selectExpr(value, "file_name")


def ingest_parse(spark, sf_dir):
    good, _ = split_rejects(parse_telemetry(_lines(spark, sf_dir)))
    return naive_times(with_shard(good).drop("file_name"))


def ingest_damaged_good(spark, sf_dir):
    good, _ = split_rejects(parse_telemetry(_damaged_lines(spark, sf_dir)))
    return naive_times(with_shard(good).drop("file_name"))


def ingest_rejects(spark, sf_dir):
    _, bad = split_rejects(parse_telemetry(_damaged_lines(spark, sf_dir)))
    return bad.withColumn("reject_reasons", F.array_join("reject_reasons", ","))


def ingest_counts(spark, sf_dir):
    return ingest_report(parse_telemetry(_damaged_lines(spark, sf_dir)))


def _drop_folder(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_folder(spark, "uploads")
    lines = _lines(spark, sf_dir).withColumnRenamed("file_name", "upload")
    # Few part files, each far below the size an upload may have.
    gathered = lines.hint("rebalance", "upload").write.option("maxRecordsPerFile", 500_000)
    gathered.partitionBy("upload").text(path)
    return path


def folder_load(spark, sf_dir):
    """Upload files -> month table -> read back."""
    uploads, out = _drop_folder(spark, sf_dir), scratch_folder(spark, "load")
    load_folder(spark, uploads, f"{out}/store", f"{out}/log")
    return naive_times(read_telemetry(spark, table_path(f"{out}/store"), *WHOLE))


def stream_ingest(spark, sf_dir):
    """Upload files -> streaming load -> month table -> read back."""
    uploads, out = _drop_folder(spark, sf_dir), scratch_folder(spark, "stream")
    ingest_stream(spark, uploads, f"{out}/store", f"{out}/checkpoint").awaitTermination()
    return naive_times(read_telemetry(spark, table_path(f"{out}/store"), *WHOLE))


def folded_records(spark, sf_dir):
    """Events stored by four loads, folded month by month, then a fifth load and one that is repeated."""
    path = scratch_folder(spark, "folded-table")
    events = with_shard(_events(spark, sf_dir), route="record_time")

    def load_part(part: int) -> None:
        append_telemetry(events.filter(F.pmod("direction", F.lit(5)) == part), path, f"load-{part}")

    for part in range(4):
        load_part(part)
    for (month,) in sorted(events.select("shard").distinct().collect()):
        compact_month(spark, path, month)
        remove_replaced(spark, path, month)
    load_part(4)
    load_part(0)
    return naive_times(read_telemetry(spark, path, *WHOLE))


def load_report_per_file(spark, sf_dir):
    """Lines seen, stored and rejected of every upload, as the load wrote them into its log."""
    uploads, out = scratch_folder(spark, "uploads"), scratch_folder(spark, "load")
    lines = _damaged_lines(spark, sf_dir).withColumnRenamed("file_name", "upload")
    lines.hint("rebalance", "upload").write.partitionBy("upload").text(uploads)
    load_folder(spark, uploads, f"{out}/store", f"{out}/log")
    return load_log(spark, f"{out}/log").drop("load_id")


def refused_uploads(spark, sf_dir):
    """Uploads turned away by a stream and a folder load over one ledger, and why.

    Every day comes three times: under its own name for the stream, again for the folder load, and
    under a name that breaks a rule, by the day of the month.
    """
    out, day = scratch_folder(spark, "refused"), F.dayofmonth("record_time")
    lines = _events(spark, sf_dir).select(upload_line(_events(spark, sf_dir)).alias("value"), "record_time")
    own = _upload_name_of_day(F.col("record_time"))
    broken = (
        F.when(day % 4 == 0, F.concat(own, F.lit(".pdf")))
        .when(day % 4 == 1, F.concat(F.lit("a b"), own))
        .when(day % 4 == 2, F.regexp_replace(own, "_2024_01_", "_2024_13_"))
        .otherwise(F.concat(F.lit("x"), own))
    )
    for folder, name in (("first", own), ("again", own), ("broken", broken)):
        named = lines.select("value", name.alias("upload")).hint("rebalance", "upload")
        named.write.partitionBy("upload").text(f"{out}/in/{folder}")
    store, log = f"{out}/store", f"{out}/log"
    ingest_stream(spark, f"{out}/in/first", store, f"{out}/checkpoint", log=log).awaitTermination()
    load_folder(spark, f"{out}/in", store, log)
    return load.refused_uploads(spark, log).select("file_name", "reason")


def stream_speed_windows(spark, sf_dir):
    """Windows kept by the monitor over a stream of the events file."""
    events = table(spark, sf_dir, "events")
    # A pattern, because a stream source takes folders and patterns but no single file.
    stream = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/{{events}}.parquet")
    out = scratch_folder(spark, "monitor")
    windows = monitor_stream(events_telemetry(stream).select(*SPEED_INPUT))
    start_monitor(windows, f"{out}/windows", f"{out}/checkpoint", trigger=None).awaitTermination()
    return naive_times(latest_windows(spark, f"{out}/windows"))


def stream_late_windows(spark, sf_dir):
    """Windows of a store after two refreshes, of which the second brings the older samples."""
    out = scratch_folder(spark, "late")
    samples = _events(spark, sf_dir).select(*SPEED_INPUT)
    early = F.col("record_time") < F.lit("2024-01-10").cast("timestamp")
    for part in (samples.filter(~early), samples.filter(early)):
        part.write.mode("append").parquet(f"{out}/in")
        stream = spark.readStream.schema(samples.schema).parquet(f"{out}/in")
        start_window_store(stream, f"{out}/windows", f"{out}/checkpoint", trigger=None).awaitTermination()
    return naive_times(stored_windows(spark, f"{out}/windows"))


def jdbc_roundtrip(spark, sf_dir):
    """Months of orders through database tables.

    The connection comes from ``spark.roadpulse.jdbc.url`` (and ``.driver``). A local
    session without it uses an in-process database, which only its own JVM sees.
    """
    months = [
        ("1996_12", "1996-12-01", "1996-12-31T23:59:59"),
        ("1997_01", "1997-01-01", "1997-01-31T23:59:59"),
    ]
    options = _jdbc_options(spark)
    for month, first, last in months:
        append_jdbc(in_range(_orders(spark, sf_dir), first, last), TABLE_PREFIX + month, options)
    found = read_jdbc_telemetry(spark, "1996-12-10", "1997-02-10", options=options, slices=4)
    return naive_times(found.select(*TELEMETRY_COLUMNS))


def jdbc_append_once(spark, sf_dir):
    """All events through a database table in three loads, each of them appended twice.

    The table's name is new for each run, so that a run on a shared database starts from nothing.
    """
    options = _jdbc_options(spark)
    name = f"{TABLE_PREFIX}once_{uuid.uuid4().hex[:8]}"
    events = _events(spark, sf_dir)
    for part in range(3):
        mine = events.filter(F.pmod("direction", F.lit(3)) == part)
        for _ in range(2):
            append_jdbc_once(mine, name, options, f"load-{part}")
    found = read_jdbc_shard(spark, name, *WHOLE, options=options)
    return naive_times(found)


def _jdbc_options(spark: SparkSession) -> dict:
    url = spark.conf.get("spark.roadpulse.jdbc.url", None)
    if url is not None:
        driver = spark.conf.get("spark.roadpulse.jdbc.driver")
        return {"url": url, "driver": driver}
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.roadpulse.jdbc.url to a database the executors can reach")
    return {
        "url": f"jdbc:derby:memory:{uuid.uuid4().hex};create=true",
        "driver": "org.apache.derby.jdbc.EmbeddedDriver",
    }


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        behavior_summary_all,
        behavior_summary_range,
        behavior_summary_driver,
        behavior_summary_display,
        behavior_summary_json,
        drivers_active,
        speed_series_all,
        speed_series_driver,
        speed_series_as_json,
        speed_series_json_all,
        speed_points_clean,
        speed_windows_3min,
        speed_windows_driver,
        overspeed_window_alerts,
        window_points_3min,
        window_lists_daily,
        window_lists_parts,
        month_shards_range,
        month_row_counts,
        multi_shard_records,
        multi_shard_summary,
        multi_shard_drivers,
        multi_shard_speed,
        shards_with_missing_month,
        every_shard_and_missing,
        union_missing_columns,
        normalized_times,
        file_admission,
        new_files_only,
        ingest_parse,
        ingest_damaged_good,
        ingest_rejects,
        ingest_counts,
        folder_load,
        folded_records,
        stream_ingest,
        load_report_per_file,
        refused_uploads,
        stream_speed_windows,
        stream_late_windows,
        jdbc_roundtrip,
        jdbc_append_once,
    )
}
