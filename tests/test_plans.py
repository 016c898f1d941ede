"""What reaches the scan, and what is shuffled."""

import re

import pytest
from records import at, records

from roadpulse.operators.behavior import behavior_summary
from roadpulse.operators.load import append_telemetry
from roadpulse.operators.parse import parse_telemetry, split_rejects
from roadpulse.operators.speed import overspeed_alerts
from roadpulse.schema import SUMMARY_INPUT
from roadpulse.sources.files import admitted_lines, read_lines
from roadpulse.sources.table import read_telemetry


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "table")
    rows = [{"driverID": "a", "record_time": at(f"2017-0{m}-05")} for m in range(1, 8)]
    df = records(spark, *rows).selectExpr("*", "date_format(record_time, 'yyyy_MM') AS shard")
    append_telemetry(df, path)
    return path


def test_only_the_months_of_the_range_are_listed(spark, stored):
    plan = plan_of(read_telemetry(spark, stored, "2017-02-10", "2017-04-10"))
    assert "InMemoryFileIndex(3 paths)" in plan
    assert "shard=2017_02" in plan and "shard=2017_01" not in plan


def test_time_and_driver_filters_and_columns_reach_parquet(spark, stored):
    plan = plan_of(read_telemetry(spark, stored, "2017-02-10", "2017-04-10", "a", ["speed"]))
    assert "EqualTo(driverID,a)" in plan
    assert "GreaterThanOrEqual(record_time,2017-02-10 00:00:00.0)" in plan
    assert "ReadSchema: struct<driverID:string,speed:int,record_time:timestamp>" in plan


def test_summary_has_one_shuffle_after_partial_aggregation(spark, stored):
    source = read_telemetry(spark, stored, "2017-01-01", "2017-08-01", columns=SUMMARY_INPUT)
    plan = plan_of(behavior_summary(source))
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan
    assert "latitude" not in plan and "siteName" not in plan


def test_alerts_filter_the_flag_in_the_scan(spark, stored):
    source = read_telemetry(spark, stored, "2017-01-01", "2017-08-01")
    plan = plan_of(overspeed_alerts(source, "2017-01-01", "2017-08-01"))
    assert re.search(r"PushedFilters: \[.*EqualTo\(isOverspeed,true\)", plan)
    assert plan.count("Exchange") == 1


def test_parse_converts_once_inside_generated_code(spark, tmp_path):
    (tmp_path / "detail_record_2017_01_02_00_00_00.csv").write_text("a,b\n")
    good, _ = split_rejects(parse_telemetry(admitted_lines(read_lines(spark, str(tmp_path)))))
    plan = plan_of(good)
    assert plan.count("split(line") == 1
    assert plan.count("try_cast(") == 17
    outside = [row for row in plan.splitlines() if "- " in row and "*(1)" not in row]
    assert all("FileScan" in row for row in outside)


def test_admission_rules_are_applied_to_the_file_listing(spark, tmp_path):
    (tmp_path / "detail_record_2017_01_02_00_00_00.csv").write_text("a,b\n")
    (tmp_path / "refused.pdf").write_text("c,d\n")
    df = admitted_lines(read_lines(spark, str(tmp_path)))
    assert df.count() == 1
    df.collect()
    scan = df._jdf.queryExecution().executedPlan()
    while scan.children().size():
        scan = scan.children().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1
