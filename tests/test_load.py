import glob

import pyarrow.parquet as pq
import pytest
from records import at, records, tuples

from roadpulse.operators.load import (
    append_telemetry,
    load_folder,
    load_log,
    read_rejects,
    table_path,
)
from roadpulse.session import scratch_folder
from roadpulse.sources.table import read_shards, read_telemetry, union_shards

NAME = "detail_record_2017_01_%02d_00_00_00.csv"
GOOD = "d%d,P,1,2,3,4,s,2017-01-05 08:00:00\n"
SPAN = ("2017-01-01", "2017-02-01")


@pytest.fixture
def place(tmp_path):
    folder = tmp_path / "some folder é"
    (folder / "in").mkdir(parents=True)
    return folder


def load(spark, place, **options):
    names = [str(place / n) for n in ("in", "store", "log")]
    return load_folder(spark, *names, **options)


def stored(spark, place, span=SPAN):
    found = read_telemetry(spark, table_path(str(place / "store")), *span)
    return sorted(r["driverID"] for r in found.collect())


def test_only_new_admitted_files_are_loaded(spark, place):
    (place / "in" / (NAME % 2)).write_text(GOOD % 1 + "\nd9,P,bad\n")
    (place / "in" / "other.csv").write_text(GOOD % 7)
    first = load(spark, place)
    assert (first.seen, first.good, first.rejected) == (2, 1, 1)
    (place / "in" / (NAME % 3)).write_text(GOOD % 2)
    second = load(spark, place)
    assert (second.seen, second.good, second.rejected) == (1, 1, 0)
    third = load(spark, place)
    assert (third.seen, third.good, third.rejected) == (0, 0, 0)
    assert stored(spark, place) == ["d1", "d2"]
    logged = load_log(spark, str(place / "log")).drop("load_id")
    assert sorted(tuples(logged)) == [(NAME % 2, 2, 1, 1), (NAME % 3, 1, 1, 0)]
    rejected = read_rejects(spark, str(place / "store")).drop("load_id").collect()
    assert [tuple(r) for r in rejected] == [(NAME % 2, "d9,P,bad", ["latitude"], "2017_01")]


def test_size_of_an_upload_is_that_of_all_its_parts(spark, place, monkeypatch):
    import roadpulse.sources.files as module

    monkeypatch.setattr(module, "MAX_FILE_BYTES", 3 * len(GOOD % 1))
    for day, sizes in ((2, (1, 4)), (3, (2, 2)), (4, (1, 2))):
        folder = place / "in" / (NAME % day)
        folder.mkdir()
        for part, n in enumerate(sizes):
            (folder / f"part-{part}.txt").write_text(GOOD % day * n)
    assert load(spark, place).seen == 3
    assert stored(spark, place) == ["d4"] * 3
    assert [r.file_name for r in load_log(spark, str(place / "log")).collect()] == [NAME % 4]


def test_route_by_record_time(spark, place):
    (place / "in" / (NAME % 2)).write_text(
        GOOD % 1 + "bad,P,x\n" + (GOOD % 2).replace("2017-01", "2017-02")
    )
    report = load(spark, place, route="record_time")
    assert (report.seen, report.good, report.rejected) == (3, 2, 1)
    assert stored(spark, place) == ["d1"]
    assert stored(spark, place, ("2017-02-01", "2017-02-28")) == ["d2"]
    assert read_rejects(spark, str(place / "store")).count() == 1


def test_unfinished_load_is_repeated_without_duplicates(spark, place, monkeypatch):
    (place / "in" / (NAME % 2)).write_text(GOOD % 1)
    import roadpulse.operators.load as module

    real = module._replace_load

    def failing(df, path, *args):
        if path.endswith("log"):
            raise RuntimeError("driver lost")
        real(df, path, *args)

    monkeypatch.setattr(module, "_replace_load", failing)
    with pytest.raises(RuntimeError):
        load(spark, place, load_id="one")
    monkeypatch.setattr(module, "_replace_load", real)
    assert load(spark, place, load_id="one").good == 1
    (place / "in" / (NAME % 3)).write_text(GOOD % 2)
    assert load(spark, place, load_id="one").seen == 1
    assert stored(spark, place) == ["d1"]
    load(spark, place, load_id="two")
    assert stored(spark, place) == ["d1", "d2"]


def test_same_name_in_two_folders_is_one_file(spark, place):
    for folder in ("x", "y"):
        (place / "in" / folder).mkdir()
        (place / "in" / folder / (NAME % 2)).write_text(GOOD % 1)
    assert load(spark, place).seen == 1
    assert read_rejects(spark, str(place / "store")).count() == 0


def test_failing_write_leaves_no_rows(spark, place):
    path = table_path(str(place / "store"))
    fine = records(spark, {"driverID": "a", "record_time": at("2017-01-05 00:00")})
    append_telemetry(fine.selectExpr("*", "'2017_01' AS shard"), path)
    broken = fine.selectExpr("*", "cast(raise_error('stop') AS string) AS shard")
    with pytest.raises(Exception, match="stop"):
        append_telemetry(broken, path)
    assert stored(spark, place) == ["a"]


def test_file_month_decides_visibility(spark, place):
    late = records(spark, {"driverID": "a", "record_time": at("2017-02-05 00:00")})
    append_telemetry(late.selectExpr("*", "'2017_01' AS shard"), str(place / "table"))
    table = str(place / "table")
    assert read_telemetry(spark, table, "2017-02-01", "2017-02-28").count() == 0
    assert read_telemetry(spark, table, "2017-01-01", "2017-02-28").count() == 1


def test_files_are_sorted_by_driver_with_usable_time_statistics(spark, place):
    rows = [{"driverID": f"d{i * 7 % 100:02d}", "record_time": at("2017-01-05")} for i in range(100)]
    months = records(spark, *rows).selectExpr("*", "concat('2017_0', 1 + speed % 1) AS shard")
    months = months.selectExpr("* EXCEPT (shard)", "if(driverID < 'd50', '2017_01', '2017_02') AS shard")
    append_telemetry(months.coalesce(1), str(place / "table"))
    files = glob.glob(str(place / "table" / "*" / "*" / "*.parquet"))
    assert len(files) == 2
    for name in files:
        drivers = pq.read_table(name).column("driverID").to_pylist()
        assert drivers == sorted(drivers)
        group = pq.ParquetFile(name).metadata.row_group(0)
        times = [group.column(i) for i in range(group.num_columns)]
        time = next(c for c in times if c.path_in_schema == "record_time")
        assert time.physical_type == "INT64" and time.statistics.has_min_max


def test_missing_shard_is_skipped_and_other_failures_propagate(spark, place):
    one = records(spark, {"driverID": "a"})
    gone = lambda: spark.read.parquet(str(place / "none"))
    assert read_shards(spark, {"m1": lambda: one, "m2": gone, "m3": lambda: one}).count() == 2
    assert read_shards(spark, {"m2": gone}).count() == 0
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        read_shards(spark, {"m1": lambda: one.select("nope")})
    with pytest.raises(ZeroDivisionError):
        read_shards(spark, {"m1": lambda: 1 / 0})


def test_union_fills_missing_columns_and_widens(spark):
    a = spark.createDataFrame([("a", 1)], "driverID string, speed int")
    b = spark.createDataFrame([("b",), ("b",)], "driverID string")
    c = spark.createDataFrame([(5_000_000_000, "c")], "speed bigint, driverID string")
    got = union_shards([a, b, c])
    assert dict(got.dtypes)["speed"] == "bigint"
    assert sorted(tuples(got), key=str) == [("a", 1), ("b", None), ("b", None), ("c", 5_000_000_000)]


def test_scratch_lies_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_folder(spark, "x")
    assert base is None or path.startswith(base)
    assert path != scratch_folder(spark, "x")
