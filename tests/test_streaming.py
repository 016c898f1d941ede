import json
import os
import time
from datetime import timedelta

from records import at, records, tuples

from roadpulse.operators.load import read_rejects, table_path
from roadpulse.operators.speed import speed_windows
from roadpulse.schema import SPEED_INPUT
from roadpulse.sources.table import read_telemetry
from roadpulse.streaming.ingest import ingest_stream
from roadpulse.streaming.monitor import (
    latest_windows,
    monitor_stream,
    start_monitor,
    stream_alerts,
)

SPAN = ("2017-01-01", "2017-03-01")
START = "2017-01-01T00:00"


def drain(spark, place, **options):
    names = [str(place / n) for n in ("in", "store", "checkpoint")]
    ingest_stream(spark, *names, **options).awaitTermination()
    return sorted(
        r["driverID"]
        for r in read_telemetry(spark, table_path(str(place / "store")), *SPAN).collect()
    )


def test_files_are_loaded_once_as_they_arrive(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    line = "d%d,P,1,2,3,4,s,2017-01-05 08:00:00\n"
    first = folder / "detail_record_2017_01_02_00_00_00.csv"
    first.write_text(line % 1 + "bad,P,x\n")
    (folder / "x.pdf").write_text(line % 9)
    assert drain(spark, tmp_path) == ["d1"]
    time.sleep(1)
    first.write_text(line % 5)
    (folder / "detail_record_2017_02_02_00_00_00.csv").write_text(line % 2)
    assert drain(spark, tmp_path, max_bytes=1) == ["d1", "d2"]
    assert read_rejects(spark, str(tmp_path / "store")).count() == 1
    loads = [p.name for p in (tmp_path / "store" / "outcome=good").glob("*/load_id=*")]
    query_id = json.loads((tmp_path / "checkpoint" / "metadata").read_text())["id"]
    assert sorted(loads) == [f"load_id={query_id}_0", f"load_id={query_id}_1"]


def test_files_older_than_a_week_are_loaded(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    line = "d%d,P,1,2,3,4,s,2017-01-05 08:00:00\n"
    (folder / "detail_record_2017_01_02_00_00_00.csv").write_text(line % 1)
    assert drain(spark, tmp_path) == ["d1"]
    old = folder / "detail_record_2017_01_03_00_00_00.csv"
    old.write_text(line % 2)
    os.utime(old, (time.time() - 10 * 86400,) * 2)
    (folder / "detail_record_2017_01_04_00_00_00.csv").write_text(line % 3)
    assert drain(spark, tmp_path) == ["d1", "d2", "d3"]


def samples(spark):
    return records(
        spark,
        *[
            {
                "driverID": "ab"[i % 2],
                "record_time": at(START) + timedelta(seconds=7 * i),
                "speed": i % 90,
                "isOverspeed": i % 50 == 0,
            }
            for i in range(400)
        ],
    ).select(*SPEED_INPUT)


def stream_of(spark, df, path):
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def test_monitor_equals_batch_windows(spark, tmp_path):
    batch = samples(spark)
    live = monitor_stream(stream_of(spark, batch, str(tmp_path / "in")))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    start_monitor(live, out, checkpoint, trigger=None).awaitTermination()
    columns = ["driverID", "window_start", "window_end", "n_points", "max_speed", "is_overspeed"]
    want = speed_windows(batch, START, "2017-01-02T00:00").select(*columns)
    got = latest_windows(spark, out).select(*columns)
    assert sorted(tuples(got)) == sorted(tuples(want))


def test_later_files_update_open_windows(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    early = samples(spark).limit(1)
    early.write.parquet(path)

    def run():
        stream = spark.readStream.schema(early.schema).parquet(path)
        start_monitor(monitor_stream(stream), out, checkpoint, trigger=None).awaitTermination()
        return sum(r["n_points"] for r in latest_windows(spark, out).collect())

    assert run() == 1
    early.write.mode("append").parquet(path)
    assert run() == 2


def test_append_mode_withholds_the_open_window(spark, tmp_path):
    batch = samples(spark)
    live = monitor_stream(stream_of(spark, batch, str(tmp_path / "in")), start_offset="1 minute")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    start_monitor(live, out, checkpoint, trigger=None, output_mode="append").awaitTermination()
    closed = latest_windows(spark, out)
    every = speed_windows(batch, "2016-12-31T23:58", "2017-01-02T00:00")
    watermark = batch.agg({"record_time": "max"}).first()[0] - timedelta(minutes=1)
    assert closed.count() == every.filter(every.window_end <= watermark).count() < every.count()


def test_stream_alerts(spark, tmp_path):
    live = stream_alerts(monitor_stream(stream_of(spark, samples(spark), str(tmp_path / "in"))))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    start_monitor(live, out, checkpoint, trigger=None).awaitTermination()
    texts = {r["alert"] for r in latest_windows(spark, out).collect()}
    assert texts == {"Driver a is SPEEDING!"}
