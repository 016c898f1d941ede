from records import tuples

from roadpulse.sources.files import (
    admit_files,
    admitted_lines,
    drop_seen_files,
    list_files,
    read_lines,
)

NAME = "detail_record_2017_01_02_00_00_00"


def test_admission_rules_in_order(spark):
    cases = [
        (f"{NAME}.csv", 1024, None),
        (f"{NAME.upper()}.TXT", 1024, None),
        (NAME, 1024, None),
        ("detail_record_2017_01.csv", 1024, "pattern"),
        ("a b.csv", 1024, "characters"),
        ("x.pdf", 1024, "extension"),
        ("a b.pdf", 104857601, "extension"),
        ("a b.csv", 104857601, "size"),
        (f"{NAME}.csv", 104857600, None),
        (f"{NAME}.csv", 104857601, "size"),
        ("detail_record_2017_99_02_00_00_00.csv", 1024, "month"),
        (f"{NAME}.csv.csv", 1024, "pattern"),
        ("", 1, "characters"),
    ]
    files = spark.createDataFrame([c[:2] for c in cases], "file_name string, file_size bigint")
    got = admit_files(files).collect()
    assert [(r["file_name"], r["file_size"], r["reason"]) for r in got] == cases
    assert [r["admitted"] for r in got] == [reason is None for _, _, reason in cases]
    passed = admitted_lines(files).collect()
    assert [tuple(r) for r in passed] == [c[:2] for c in cases if c[2] is None]


def test_listing(spark, tmp_path):
    (tmp_path / f"{NAME}.csv").write_text("abc")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "x.PDF").write_text("abcd")
    got = list_files(spark, str(tmp_path)).select("file_name", "file_size", "extension")
    assert sorted(tuples(got)) == [(f"{NAME}.csv", 3, "csv"), ("x.PDF", 4, "pdf")]


def test_seen_names_are_dropped(spark):
    files = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "file_name string, n int")
    seen = spark.createDataFrame([("b",), ("b",), ("c",)], "file_name string")
    assert tuples(drop_seen_files(files, seen)) == [("a", 1)]


def test_lines_of_admitted_files_only(spark, tmp_path):
    (tmp_path / f"{NAME}.csv").write_bytes("﻿one\r\ntwo\rthree\n".encode())
    (tmp_path / "notes.pdf").write_text("no")
    got = admitted_lines(read_lines(spark, str(tmp_path)))
    assert sorted(tuples(got.select("value", "file_name"))) == [
        ("one", f"{NAME}.csv"),
        ("three", f"{NAME}.csv"),
        ("two", f"{NAME}.csv"),
    ]


def test_folder_written_by_spark_is_one_upload(spark, tmp_path):
    path = str(tmp_path / f"upload={NAME}.csv")
    spark.range(4).selectExpr("cast(id AS string) AS value").repartition(2).write.text(path)
    got = admitted_lines(read_lines(spark, str(tmp_path)))
    assert got.count() == 4
    assert tuples(got.select("file_name").distinct()) == [(f"{NAME}.csv",)]
    assert tuples(list_files(spark, str(tmp_path)).select("file_name").distinct()) == [(f"{NAME}.csv",)]
