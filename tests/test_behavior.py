import pytest
from records import at, records, tuples

from roadpulse.operators.behavior import (
    behavior_summary,
    drivers_in_range,
    summary_display,
    summary_json,
)
from roadpulse.operators.filters import for_driver, in_range
from roadpulse.operators.load import append_telemetry
from roadpulse.plans.reports import active_drivers, driving_behavior, speed_data
from roadpulse.schema import SUMMARY_SCHEMA


def test_nulls_count_as_not_true_and_sum_to_zero(spark):
    df = records(
        spark,
        {"driverID": "a", "carPlateNumber": "p", "isOverspeed": True, "overspeedTime": 5},
        {"driverID": "a", "carPlateNumber": "p", "isOverspeed": None, "isOilLeak": False},
        {"driverID": "a", "carPlateNumber": "p", "isOverspeed": True, "overspeedTime": None},
        {"driverID": "b", "carPlateNumber": None, "isFatigueDriving": True, "isOilLeak": True},
    )
    got = sorted(tuples(behavior_summary(df)), key=lambda r: r[0])
    assert got == [("a", "p", 2, 5, 0, 0, 0, 0, 0, 0, 0, 2), ("b", None, 0, 0, 1, 0, 0, 0, 0, 0, 1, 2)]


def test_summary_schema(spark):
    got = behavior_summary(records(spark)).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in SUMMARY_SCHEMA]


def test_stored_danger_count_is_recomputed(spark):
    df = records(spark, {"driverID": "a", "count_dangerEvent": 99, "isRapidlySpeedup": True})
    assert behavior_summary(df).first()["count_dangerEvent"] == 1


def test_counts_beyond_int_range(spark):
    big = 2_147_483_647
    rows = [{"driverID": "a", "overspeedTime": big}] * 3
    assert behavior_summary(records(spark, *rows)).first()["time_overspeed"] == 3 * big


def test_display_and_json(spark):
    summary = behavior_summary(records(spark, {"driverID": "", "carPlateNumber": None}))
    assert summary_display(summary).first()[:2] == ("-", "-")
    assert summary_json(summary).first()[0].startswith('{"driverID":"","carPlateNumber":null,"count_')


def test_driver_list_is_distinct_and_sorted_with_empty_first(spark):
    df = records(spark, *[{"driverID": d} for d in ("b", "", "a", "b")])
    assert tuples(drivers_in_range(df)) == [("",), ("a",), ("b",)]


def test_range_is_closed_and_drops_null_times(spark):
    times = ["2017-01-01 00:00:00", "2017-01-01 00:05:00", "2017-01-01 00:05:01", None]
    df = records(spark, *[{"record_time": t and at(t)} for t in times])
    assert in_range(df, "2017-01-01T00:00", "2017-01-01T00:05").count() == 2
    assert in_range(df, "2017-01-01T00:05", "2017-01-01T00:00").count() == 0


@pytest.mark.parametrize(("driver", "rows"), [("all", 3), (None, 3), ("a", 2), ("", 1), ("x' OR 1=1", 0)])
def test_driver_filter(spark, driver, rows):
    df = records(spark, {"driverID": "a"}, {"driverID": "a"}, {"driverID": ""})
    assert for_driver(df, driver).count() == rows


def test_required_parameters(spark, tmp_path):
    for call in (
        lambda: active_drivers(spark, str(tmp_path), "", "2017-01-01"),
        lambda: driving_behavior(spark, str(tmp_path), "2017-01-01", None),
        lambda: speed_data(spark, str(tmp_path), "2017-01-01", "2017-01-02", ""),
    ):
        with pytest.raises(ValueError):
            call()


def test_reports_on_a_stored_table(spark, tmp_path):
    rows = [
        {"driverID": "a", "record_time": at("2016-12-31 23:59:59"), "isOverspeed": True, "speed": 9},
        {"driverID": "a", "record_time": at("2017-01-01 00:00:00"), "isOverspeed": True, "speed": 8},
        {"driverID": "b", "record_time": at("2017-02-01 00:00:00"), "isOilLeak": True, "speed": 7},
    ]
    stored = records(spark, *rows).selectExpr("*", "date_format(record_time, 'yyyy_MM') AS shard")
    path = str(tmp_path / "table")
    append_telemetry(stored, path)
    span = ("2016-12-31T23:00", "2017-01-31T00:00")
    assert tuples(active_drivers(spark, path, *span)) == [("a",)]
    assert driving_behavior(spark, path, *span).first()["count_overspeed"] == 2
    assert [r["speed"] for r in speed_data(spark, path, *span, "a").collect()] == [9, 8]
    assert speed_data(spark, path, *span, "b").count() == 0
    assert active_drivers(spark, path, "2020-01-01", "2020-02-01").count() == 0
