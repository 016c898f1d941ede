"""Live speed windows and overspeed alerts over a stream of samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.functions.display import is_true, speeding_alert
from roadpulse.operators.speed import WINDOW_MINUTES
from roadpulse.session import prunable_times

REFRESH = "30 seconds"


def monitor_stream(
    samples: DataFrame,
    watermark: str = "1 minute",
    start_offset: str = "0 seconds",
    minutes: int = WINDOW_MINUTES,
) -> DataFrame:
    """Speed windows per driver, updated as samples arrive.

    A stream has no range start, so windows align to the epoch shifted by
    ``start_offset``. State is one row per driver and open window; the watermark
    closes windows and lets it go.
    """
    window = F.window("record_time", f"{minutes} minutes", startTime=start_offset)
    return (
        samples.withWatermark("record_time", watermark)
        .groupBy("driverID", window.alias("window"))
        .agg(
            F.count("*").alias("n_points"),
            F.coalesce(F.max("speed"), F.lit(0)).alias("max_speed"),
            F.bool_or(is_true(F.col("isOverspeed"))).alias("is_overspeed"),
        )
        .select(
            "driverID",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "n_points",
            "max_speed",
            "is_overspeed",
        )
    )


def stream_alerts(windows: DataFrame) -> DataFrame:
    """Windows with an overspeed sample, with the alert text."""
    alert = speeding_alert(F.col("driverID")).alias("alert")
    return windows.filter("is_overspeed").select("driverID", "window_start", "window_end", alert)


def start_monitor(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = REFRESH,
    output_mode: str = "update",
) -> StreamingQuery:
    """Write each refresh of the windows under ``path``, one folder per batch.

    Update mode shows windows that are still open; append mode only closed ones. A
    repeated batch replaces its own folder. ``trigger`` None drains and stops.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        with prunable_times(batch.sparkSession):
            (
                batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch_id")
                .parquet(path)
            )

    writer = (
        windows.writeStream.foreachBatch(write_batch)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    when = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return writer.trigger(**when).start()


def latest_windows(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of every window written by :func:`start_monitor`."""
    keys = ["driverID", "window_start", "window_end"]
    updates = spark.read.parquet(path)
    values = [c for c in updates.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*values), "batch_id").alias("newest")
    return updates.groupBy(*keys).agg(newest).select(*keys, "newest.*")
