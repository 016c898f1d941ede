"""A store of speed windows that many small refreshes keep up to date, late samples included.

Points, highest speed and the overspeed flag of a window merge, so a refresh adds what its own samples
say and no window is ever closed for good. Under the store's path lie::

    delta/batch_id=…            windows of one refresh, counted while newer than their day's snapshot
    snapshot/day=…/upto=…       windows of a day, merged from all refreshes up to a number
    late/batch_id=…             samples that came behind the watermark
    progress/batch_id=…         the newest sample's time

Every folder is replaced as a whole, and a refresh that is repeated replaces its own.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.functions.display import is_true
from roadpulse.operators.speed import WINDOW_MINUTES
from roadpulse.schema import SPEED_INPUT
from roadpulse.session import prunable_times, remove_folder
from roadpulse.sources.table import is_not_found
from roadpulse.streaming.monitor import REFRESH

_KEYS = ["driverID", "window_start", "window_end"]
_SAMPLE = {"driverID": "string", "record_time": "{time}", "speed": "int", "isOverspeed": "boolean"}
_VALUES = "n_points bigint, n_late bigint, max_speed int, is_overspeed boolean"


def start_window_store(
    samples: DataFrame,
    path: str,
    checkpoint: str,
    watermark: str = "1 minute",
    start_offset: str = "0 seconds",
    minutes: int = WINDOW_MINUTES,
    trigger: str | None = REFRESH,
    fold_every: int = 20,
) -> StreamingQuery:
    """Keep the windows of a stream of samples under ``path``.

    A sample is late if it is older than the newest sample of earlier refreshes by more than ``watermark``. Late samples
    are kept beside the windows, and the windows they belong to count them like any other. Every
    ``fold_every`` refreshes the days that changed get a new snapshot and the refreshes in it go, so
    a reader opens at most that many refreshes. ``trigger`` None drains and stops.
    """
    time_type = samples.schema["record_time"].dataType.simpleString()
    window = F.window("record_time", f"{minutes} minutes", startTime=start_offset)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        before = _newest_time(session, path, time_type, batch_id)
        limit = F.lit(before).cast(time_type) - F.expr(f"interval {watermark}")
        known = batch.select(*SPEED_INPUT).filter("record_time is not null")
        judged = known.withColumn("is_late", F.coalesce(F.col("record_time") < limit, F.lit(False)))
        windows = judged.groupBy("driverID", window.alias("window")).agg(
            F.count("*").alias("n_points"),
            F.count_if("is_late").alias("n_late"),
            F.coalesce(F.max("speed"), F.lit(0)).alias("max_speed"),
            F.bool_or(is_true(F.col("isOverspeed"))).alias("is_overspeed"),
        )
        delta = windows.select(
            "driverID", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            "n_points", "n_late", "max_speed", "is_overspeed",
        )
        with prunable_times(session):
            _replace(judged.filter("is_late").drop("is_late"), f"{path}/late/batch_id={batch_id}")
            _replace(delta, f"{path}/delta/batch_id={batch_id}")
            newest = known.agg(F.greatest(F.max("record_time"), F.lit(before).cast(time_type)).alias("newest"))
            _replace(newest, f"{path}/progress/batch_id={batch_id}")
            if (batch_id + 1) % fold_every == 0:
                fold_windows(session, path, time_type, batch_id)
        remove_folder(session, f"{path}/progress/batch_id={batch_id - 2}")

    writer = samples.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    when = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return writer.trigger(**when).start()


def _replace(df: DataFrame, folder: str) -> None:
    df.coalesce(4).write.mode("overwrite").parquet(folder)


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).option("basePath", folder).parquet(folder)
    except AnalysisException as error:
        if not is_not_found(error):
            raise
        return spark.createDataFrame([], schema)


def _newest_time(spark: SparkSession, path: str, time_type: str, batch_id: int) -> str | None:
    progress = _read(spark, f"{path}/progress", f"newest {time_type}, batch_id bigint")
    return progress.filter(F.col("batch_id") < batch_id).agg(F.max("newest").cast("string")).first()[0]


def _schema(time_type: str, *more: str) -> str:
    return ", ".join([f"driverID string, window_start {time_type}, window_end {time_type}, {_VALUES}", *more])


def _parts(spark: SparkSession, path: str, time_type: str) -> DataFrame:
    """Rows of the newest snapshot of each day and of the refreshes after it, with their day and number."""
    snapshots = _read(spark, f"{path}/snapshot", _schema(time_type, "day string, upto bigint"))
    deltas = _read(spark, f"{path}/delta", _schema(time_type, "batch_id bigint"))
    deltas = deltas.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
    # One row a day and snapshot: folders, not windows.
    newest = snapshots.groupBy("day").agg(F.max("upto").alias("newest"))
    current = snapshots.join(newest, "day").filter(F.col("upto") == F.col("newest"))
    later = deltas.join(newest, "day", "left").filter(F.col("batch_id") > F.coalesce("newest", F.lit(-1)))
    columns = [*_KEYS, "n_points", "n_late", "max_speed", "is_overspeed", "day"]
    return current.select(*columns, F.col("upto").alias("number")).unionAll(
        later.select(*columns, F.col("batch_id").alias("number"))
    )


def _merged(parts: DataFrame, *keys: str) -> DataFrame:
    return parts.groupBy(*_KEYS, *keys).agg(
        F.sum("n_points").alias("n_points"), F.sum("n_late").alias("n_late"),
        F.max("max_speed").alias("max_speed"), F.bool_or("is_overspeed").alias("is_overspeed"),
    )


def fold_windows(spark: SparkSession, path: str, time_type: str, upto: int) -> None:
    """Give the days that refreshes up to a number have changed a new snapshot, and remove what it replaces.

    A reader counts a refresh only beyond its day's snapshot, so it sees right windows at any moment, and
    a fold that is cut off may be repeated.
    """
    deltas = _read(spark, f"{path}/delta", _schema(time_type, "batch_id bigint")).filter(F.col("batch_id") <= upto)
    changed = deltas.select(F.date_format("window_start", "yyyy-MM-dd").alias("day")).distinct()
    parts = _parts(spark, path, time_type).filter(F.col("number") <= upto)
    folded = _merged(parts.join(changed, "day", "left_semi"), "day").withColumn("upto", F.lit(upto).cast("bigint"))
    (
        folded.hint("rebalance", "day").sortWithinPartitions("day", *_KEYS).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("day", "upto").parquet(f"{path}/snapshot")
    )
    files, target = _file_system(spark, path)
    for status in files.listStatus(_child(spark, target, "delta")):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and int(name.split("=")[1]) <= upto:
            files.delete(status.getPath(), True)
    for day in files.listStatus(_child(spark, target, "snapshot")):
        if not day.getPath().getName().startswith("day="):
            continue
        found = sorted(
            (int(s.getPath().getName().split("=")[1]), s.getPath()) for s in files.listStatus(day.getPath())
        ) if day.isDirectory() else []
        for _, old in found[:-1]:
            files.delete(old, True)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _child(spark: SparkSession, target, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, name)


def stored_windows(spark: SparkSession, path: str, time_type: str = "timestamp") -> DataFrame:
    """Every window of the store with n_points, n_late, max_speed and is_overspeed, late samples included."""
    return _merged(_parts(spark, path, time_type)).select(*_KEYS, "n_points", "n_late", "max_speed", "is_overspeed")


def late_samples(spark: SparkSession, path: str, time_type: str = "timestamp") -> DataFrame:
    """Samples that came behind the watermark, with the refresh that brought them."""
    fields = ", ".join(f"{c} {t}" for c, t in _SAMPLE.items()).format(time=time_type)
    return _read(spark, f"{path}/late", f"{fields}, batch_id bigint")

