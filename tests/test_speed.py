from collections import defaultdict
from datetime import datetime, timedelta
from random import Random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from records import at, records, tuples

from roadpulse.operators.filters import in_scan_order
from roadpulse.operators.positions import with_positions
from roadpulse.operators.speed import (
    overspeed_alerts,
    speed_points,
    speed_series,
    speed_series_json,
    speed_windows,
    window_lists,
    window_points,
)

START = "2017-01-01T00:00"


def minute_samples(spark, n):
    return records(
        spark,
        *[
            {"driverID": "a", "record_time": at(START) + timedelta(minutes=m), "speed": 10 * m}
            for m in range(n)
        ],
    )


def test_sample_at_the_end_is_in_no_window(spark):
    df = minute_samples(spark, 7)
    got = tuples(speed_windows(df, START, "2017-01-01T00:06").orderBy("window_index"))
    assert [r[1:6] for r in got] == [
        (0, at("2017-01-01 00:00"), at("2017-01-01 00:03"), 3, 20),
        (1, at("2017-01-01 00:03"), at("2017-01-01 00:06"), 3, 50),
    ]
    assert got[0][7] == "Driver a - 2017-01-01 - 12:00:00 AM - 12:03:00 AM"


def test_partial_last_window_keeps_its_end(spark):
    got = speed_windows(minute_samples(spark, 9), START, "2017-01-01T00:07").orderBy("window_index")
    assert [r["n_points"] for r in got.collect()] == [3, 3, 2]


def test_null_speed_and_flag(spark):
    df = records(spark, {"driverID": "a", "record_time": at(START)})
    row = speed_windows(df, START, "2017-01-01T01:00").first()
    assert (row["max_speed"], row["is_overspeed"]) == (0, False)
    point = speed_points(df).first()
    assert (point["speed"], point["isOverspeed"], point["colour"]) == (0.0, False, "#00ff51")


def test_points_without_time_are_dropped(spark):
    assert speed_points(records(spark, {"driverID": "a"})).count() == 0


def test_alerts(spark):
    df = records(
        spark,
        {"driverID": "a", "record_time": at("2017-01-01 00:01"), "isOverspeed": True},
        {"driverID": "a", "record_time": at("2017-01-01 00:04"), "isOverspeed": False},
        {"driverID": "b", "record_time": at("2017-01-01 00:04"), "isOverspeed": None},
    )
    got = overspeed_alerts(df, START, "2017-01-01T01:00").collect()
    assert [(r["window_index"], r["alert"]) for r in got] == [(0, "Driver a is SPEEDING!")]


def test_series_is_sorted_and_json_leaves_out_nulls(spark):
    df = records(
        spark,
        {"driverID": "a", "record_time": at("2017-01-01 08:00:11"), "isOverspeed": True},
        {"driverID": "a", "record_time": at("2017-01-01 08:00:10"), "speed": 5},
    )
    assert [r["speed"] for r in speed_series(df).collect()] == [5, None]
    assert [r[0] for r in speed_series_json(df).collect()] == [
        '{"record_time":"2017-01-01T08:00:10.000Z","speed":5}',
        '{"record_time":"2017-01-01T08:00:11.000Z","isOverspeed":true}',
    ]


def test_points_are_ordered_within_windows(spark):
    df = minute_samples(spark, 6).orderBy(F.desc("record_time"))
    got = window_points(df, START, "2017-01-01T00:06").collect()
    assert [(r["window_index"], r["speed"], r["label"]) for r in got] == [
        (m // 3, 10.0 * m, f"12:0{m}:00 AM") for m in range(6)
    ]


moments = st.integers(0, 40 * 60).map(lambda s: datetime(2017, 1, 1) + timedelta(seconds=s))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), moments, st.integers(0, 9)), max_size=30),
    moments,
    moments,
)
def test_windows_equal_brute_force(spark, samples, start, end):
    rows = [{"driverID": d, "record_time": t, "speed": s} for d, t, s in samples]
    expected = defaultdict(list)
    for driver, time, speed in samples:
        index, lower = 0, start
        while lower < end:
            if lower <= time < lower + timedelta(minutes=3) and time <= end:
                expected[driver, index].append(speed)
            index, lower = index + 1, lower + timedelta(minutes=3)
    got = speed_windows(records(spark, *rows), start, end).collect()
    assert {(r["driverID"], r["window_index"]): (r["n_points"], r["max_speed"]) for r in got} == {
        key: (len(speeds), max(speeds)) for key, speeds in expected.items()
    }


@pytest.mark.parametrize("max_points", [1, 100, 20_000])
def test_crowded_window_is_split_without_losing_or_reordering(spark, max_points):
    random = Random(5)
    rows = [
        {
            "driverID": None if i % 5 == 0 else "hot",
            "record_time": at(START) + timedelta(seconds=random.choice([1, 1, 1, 2, 90, 179])),
            "speed": i % 200,
        }
        for i in range(2000)
    ] + [{"driverID": "cold", "record_time": at(START), "speed": s} for s in range(5)]
    df = records(spark, *rows).repartition(4)
    got = window_lists(df, START, "2017-01-01T01:00", max_points=max_points).collect()
    gathered = defaultdict(list)
    parts = {key: max(r["part"] for r in got if r["driverID"] == key) for key in (None, "hot", "cold")}
    for row in sorted(got, key=lambda r: r["part"]):
        full = len(row["labels"]) == max_points
        assert full or row["part"] == parts[row["driverID"]] and len(row["labels"]) < max_points
        gathered[row["driverID"]] += zip(row["labels"], row["speeds"], strict=True)
    for driver, points in gathered.items():
        labels = [label for label, _ in points]
        assert labels == sorted(labels)
        want = [
            (r["record_time"].strftime("%I:%M:%S %p"), float(r["speed"]))
            for r in rows
            if r["driverID"] == driver
        ]
        assert sorted(points) == sorted(want)
    for driver, points in gathered.items():
        assert parts[driver] == (len(points) - 1) // max_points


def test_equal_times_are_spread_over_sort_tasks(spark):
    same = spark.range(0, 20000, 1, 4).select(F.lit(1).alias("t"), "id")
    placed = in_scan_order(same, "t").withColumn("task", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in placed.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 20000
    assert max(sizes) < 20000 / 3


def test_positions_in_a_group_that_most_tasks_hold(spark):
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 10 < 8, F.lit(None)).otherwise(F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("t"), "id"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_positions(df, ["k"], ["t"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = defaultdict(list)
    for r in got:
        groups[r["k"]].append(r)
    assert sorted(r["id"] for r in got) == list(range(30_000))
    for rows in groups.values():
        rows.sort(key=lambda r: r["position"])
        assert [r["position"] for r in rows] == list(range(len(rows)))
        assert [r["t"] for r in rows] == sorted(r["t"] for r in rows)


def test_positions_of_nothing(spark):
    assert with_positions(spark.range(0), ["id"], []).collect() == []
