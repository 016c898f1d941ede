"""Folding loads into snapshots, against the rows of the loads."""

import glob
from datetime import timedelta

import pytest
from records import at, records

from roadpulse.operators.compact import compact_month
from roadpulse.operators.load import append_telemetry
from roadpulse.sources.manifest import publish, remove_replaced
from roadpulse.sources.table import read_telemetry

RANGE = ("2017-01-01", "2017-02-28T23:59:59")
MONTH = "2017_01"


def load(spark, path, load_id, month=1, rows=40):
    made = [
        {
            # A driver has a third of all rows, some have none of a name, and times repeat.
            "driverID": "hot" if i % 3 == 0 else None if i % 17 == 1 else f"d{i % 20:02d}",
            "record_time": at(f"2017-{month:02d}-05") + timedelta(hours=(i * 7) % 300),
            "speed": i,
        }
        for i in range(rows)
    ]
    df = records(spark, *made).selectExpr("*", f"'2017_{month:02d}' AS shard")
    append_telemetry(df, path, load_id)


def stored(spark, path, driver="all", span=RANGE):
    columns = ["driverID", "record_time", "speed", "load_id", "shard"]
    return sorted(map(tuple, read_telemetry(spark, path, *span, driver, columns).collect()), key=repr)


@pytest.fixture
def path(spark, tmp_path):
    path = str(tmp_path / "table")
    for load_id in "abcdef":
        load(spark, path, load_id)
    load(spark, path, "g", month=2)
    return path


def test_fewer_files_and_the_same_rows(spark, path):
    before, one = stored(spark, path), stored(spark, path, "d04")
    report = compact_month(spark, path, MONTH, rows_per_file=100)
    assert (report.loads, report.rows) == (6, 240) and report.files <= 3
    assert stored(spark, path) == before and stored(spark, path, "d04") == one != []
    assert remove_replaced(spark, path, MONTH) == 6
    assert stored(spark, path) == before and stored(spark, path, "d04") == one
    assert len(glob.glob(f"{path}/shard={MONTH}/*/*.parquet")) == 0
    assert compact_month(spark, path, MONTH) is None


def test_repeated_load_changes_nothing_and_a_new_one_is_seen(spark, path):
    compact_month(spark, path, MONTH)
    remove_replaced(spark, path, MONTH)
    before = stored(spark, path)
    load(spark, path, "b")
    assert stored(spark, path) == before
    load(spark, path, "new", rows=50)
    grown = stored(spark, path)
    assert len(grown) == len(before) + 50
    report = compact_month(spark, path, MONTH)
    assert (report.loads, report.rows) == (1, 290)
    assert stored(spark, path) == grown
    assert remove_replaced(spark, path, MONTH) == 2
    assert stored(spark, path) == grown
    assert len(glob.glob(f"{path}/_folded/shard={MONTH}/*")) == 1


def test_the_later_of_two_folds_gives_way(spark, path, monkeypatch):
    before = stored(spark, path)

    def overtaken(spark, path, month, *rest):
        monkeypatch.undo()
        assert compact_month(spark, path, month).rows == 240
        return publish(spark, path, month, *rest)

    monkeypatch.setattr("roadpulse.operators.compact.publish", overtaken)
    assert compact_month(spark, path, MONTH) is None
    assert stored(spark, path) == before
    assert len(glob.glob(f"{path}/_folded/shard={MONTH}/*")) == 1


def test_removal_leaves_the_files_of_a_fold_at_work(spark, path, monkeypatch):
    compact_month(spark, path, MONTH)
    load(spark, path, "new")
    before = stored(spark, path)

    def meanwhile(spark, path, month, *rest):
        assert remove_replaced(spark, path, month) == 6
        return publish(spark, path, month, *rest)

    monkeypatch.setattr("roadpulse.operators.compact.publish", meanwhile)
    assert compact_month(spark, path, MONTH).rows == 280
    assert stored(spark, path) == before


def test_a_fold_that_is_cut_off_leaves_the_loads(spark, path, monkeypatch):
    before = stored(spark, path)
    monkeypatch.setattr("roadpulse.operators.compact.publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        compact_month(spark, path, MONTH)
    monkeypatch.undo()
    assert stored(spark, path) == before
    assert compact_month(spark, path, MONTH).rows == 240
    remove_replaced(spark, path, MONTH)
    assert stored(spark, path) == before
    assert len(glob.glob(f"{path}/_folded/shard={MONTH}/*")) == 1


def test_one_driver_opens_a_small_share_of_a_month(spark, path):
    before = read_telemetry(spark, path, *RANGE, "d04").inputFiles()
    assert len([f for f in before if MONTH in f]) >= 6
    compact_month(spark, path, MONTH, rows_per_file=10)
    remove_replaced(spark, path, MONTH)
    whole = [f for f in read_telemetry(spark, path, *RANGE).inputFiles() if MONTH in f]
    one = [f for f in read_telemetry(spark, path, *RANGE, "d04").inputFiles() if MONTH in f]
    assert len(whole) >= 20 and 1 <= len(one) <= 3
    # A driver with a third of the rows lies in many files; a short range opens few of them.
    hot = [f for f in read_telemetry(spark, path, *RANGE, "hot").inputFiles() if MONTH in f]
    hour = ("2017-01-06T00:00", "2017-01-06T01:00")
    brief = [f for f in read_telemetry(spark, path, *hour, "hot").inputFiles() if MONTH in f]
    assert len(hot) >= 6 and len(brief) <= 2
    assert stored(spark, path, "hot", hour) == [r for r in stored(spark, path, "hot") if at(hour[0]) <= r[1] <= at(hour[1])]


def test_absent_drivers_months_and_tables(spark, path, tmp_path):
    assert compact_month(spark, path, "2018_01") is None
    assert compact_month(spark, str(tmp_path / "none"), MONTH) is None
    assert remove_replaced(spark, path, MONTH) == 0
    compact_month(spark, path, MONTH)
    assert stored(spark, path, "zz") == []
