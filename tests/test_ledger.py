"""One ledger for every way in: names stored once, all parts or none, nothing doubled after a crash."""

import os
import time

import pytest
from records import tuples

import roadpulse.operators.load as load_module
import roadpulse.sources.files as files_module
import roadpulse.sources.ledger as ledger_module
from roadpulse.operators.load import load_folder, load_log, refused_uploads, table_path
from roadpulse.sources.files import list_files, read_lines
from roadpulse.sources.ledger import Ledger
from roadpulse.sources.table import read_telemetry
from roadpulse.streaming.ingest import ingest_stream

NAME = "detail_record_2017_01_%02d_00_00_00.csv"
LINE = "d%d,P,1,2,3,4,s,2017-01-05 08:00:00\n"


class Place:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        (root / "in").mkdir()

    def put(self, name, *lines, folder="in"):
        path = self.root / folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("".join(LINE % d if isinstance(d, int) else d for d in lines))
        return path

    def load(self, folder="in", **options):
        return load_folder(self.spark, *(str(self.root / n) for n in (folder, "store", "log")), **options)

    def stream(self, folder="in", **options):
        names = (str(self.root / n) for n in (folder, "store", f"checkpoint-{folder}"))
        ingest_stream(self.spark, *names, log=str(self.root / "log"), **options).awaitTermination()

    def stored(self):
        found = read_telemetry(self.spark, table_path(str(self.root / "store")), "2017-01-01", "2017-02-01")
        return sorted(r.driverID for r in found.collect())

    def refused(self):
        rows = refused_uploads(self.spark, str(self.root / "log")).collect()
        return sorted((r.file_name, r.reason) for r in rows)


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def test_a_name_is_stored_once_through_folder_stream_or_both(place):
    place.put(NAME % 1, 1)
    place.load()
    place.put(NAME % 1, 7, folder="in2")
    place.put(NAME % 2, 2, folder="in2")
    place.stream("in2")
    assert place.stored() == ["d1", "d2"]
    place.put("later/" + NAME % 2, 8, folder="in2")
    place.put("x.pdf", 9, folder="in2")
    place.stream("in2")
    place.put("deep/" + NAME % 2, 9)
    place.load()
    place.load()
    assert place.stored() == ["d1", "d2"]
    assert place.refused() == [(NAME % 1, "duplicate"), (NAME % 2, "duplicate"), (NAME % 2, "duplicate"), ("x.pdf", "extension")]


def test_a_refused_upload_may_come_again(place):
    place.put("a b.csv", 1)
    assert place.load().seen == 0
    os.rename(place.root / "in" / "a b.csv", place.root / "in" / (NAME % 1))
    assert place.load().seen == 1
    place.put(NAME % 1, 1, 1)
    assert place.load().seen == 0
    assert place.refused() == [("a b.csv", "characters"), (NAME % 1, "changed")]


def test_a_stream_stores_all_parts_or_none(place, monkeypatch):
    monkeypatch.setattr(files_module, "MAX_FILE_BYTES", 3 * len(LINE % 1))
    for day, sizes in ((2, (1, 4)), (3, (2, 2)), (4, (1, 2))):
        for part, n in enumerate(sizes):
            place.put(f"{NAME % day}/part-{part}", *[day] * n)
    place.stream(max_bytes=1)
    assert place.stored() == ["d4"] * 3
    assert place.refused() == [(NAME % 2, "size"), (NAME % 3, "size")]


def test_uploads_below_a_folder_named_like_a_part(spark, place):
    for day in (1, 2):
        for part in (1, 2):
            place.put(f"part-a/u/{NAME % day}/part-{part}", day)
    listed = list_files(spark, str(place.root / "in")).select("file_name", "upload", "file_size").distinct()
    assert listed.count() == 2 and {r.file_size for r in listed.collect()} == {2 * len(LINE % 1)}
    assert place.load().good == 4


def test_an_upload_still_growing_is_held(place):
    parts = [place.put(f"{NAME % 1}/part-{i}", i) for i in (1, 2)]
    place.stream(settle_seconds=3600)
    place.load(settle_seconds=3600)
    place.put(f"{NAME % 1}/part-3", 3)
    place.stream(settle_seconds=3600)
    assert not (place.root / "store" / "outcome=good").exists()
    for path in (*parts, place.root / "in" / (NAME % 1) / "part-3"):
        os.utime(path, (time.time() - 7200,) * 2)
    place.stream(settle_seconds=3600)
    assert place.stored() == ["d1", "d2", "d3"]
    place.stream(settle_seconds=3600)
    place.load()
    assert place.stored() == ["d1", "d2", "d3"] and place.refused() == []


class Crash(RuntimeError):
    pass


@pytest.mark.parametrize("way", ["load", "stream"])
@pytest.mark.parametrize("moment", ["before the store", "before the log", "before the entry goes"])
def test_a_crash_leaves_neither_doubles_nor_orphans(place, monkeypatch, way, moment):
    place.put(NAME % 1, 1, "bad,P,x\n")
    place.put(NAME % 2, 2)

    def crash(*args, **kwargs):
        raise Crash

    with monkeypatch.context() as patch:
        if moment == "before the store":
            patch.setattr(load_module, "load_lines", crash)
        elif moment == "before the log":
            real = load_module._replace_load
            patch.setattr(load_module, "_replace_load", lambda df, path, *a: crash() if path.endswith("log") else real(df, path, *a))
        else:
            patch.setattr(ledger_module.Ledger, "release", crash)
        with pytest.raises(Exception):
            getattr(place, way)()
    # A file that arrives between crash and repeat does not join the crashed load.
    place.put(NAME % 3, 3)
    getattr(place, way)()
    assert place.stored() == ["d1", "d2", "d3"]
    loads = {p.name for p in (place.root / "store").glob("outcome=good/*/load_id=*")}
    assert loads == {f"load_id={r.load_id}" for r in load_log(place.spark, str(place.root / "log")).collect()}
    assert Ledger(place.spark, str(place.root / "log")).pending().count() == 0
    place.stream() if way == "load" else place.load()
    assert place.stored() == ["d1", "d2", "d3"]


def test_another_applications_load_is_left_alone_until_its_lease_ends(place):
    place.put(NAME % 1, 1)
    ledger = Ledger(place.spark, str(place.root / "log"))
    assert ledger.claim(list_files(place.spark, str(place.root / "in")), "theirs", "file_name")
    entry = place.root / "log" / "_pending" / "load_id=theirs"
    other = place.spark.read.parquet(str(entry)).selectExpr("* except (owner)", "'another' as owner")
    rows = other.collect()
    place.spark.createDataFrame(rows, other.schema).write.mode("overwrite").parquet(str(entry))
    assert place.load().seen == 0
    assert place.load(lease_seconds=0).seen == 1
    assert place.stored() == ["d1"]


def test_a_load_opens_new_files_only(place, monkeypatch):
    place.put(NAME % 1, 1)
    place.load()
    place.put(NAME % 2, 2)
    opened = []

    def watched(spark, paths, *args, **kwargs):
        lines = read_lines(spark, paths, *args, **kwargs)
        opened.extend(lines.inputFiles())
        return lines

    monkeypatch.setattr(load_module, "read_lines", watched)
    place.load()
    assert [os.path.basename(f) for f in opened] == [NAME % 2]
    assert place.stored() == ["d1", "d2"]


def test_counts_are_those_of_each_file(place):
    place.put(NAME % 1, *[1] * 300, "bad,P,x\n")
    place.put(NAME % 2, "bad,P,x\n" * 7)
    place.put(NAME % 3)  # without a byte, no upload
    place.put(f"{NAME % 4}/part-1", 4, 4)
    place.put(f"{NAME % 4}/part-2", 4, "bad,P,x\n")
    place.load(route="record_time")
    want = [(NAME % 1, 301, 300, 1), (NAME % 2, 7, 0, 7), (NAME % 4, 4, 3, 1)]
    assert sorted(tuples(load_log(place.spark, str(place.root / "log")).drop("load_id"))) == want


def test_a_load_of_several_chunks(place, monkeypatch):
    monkeypatch.setattr(ledger_module, "CHUNK_FILES", 3)
    for day in range(1, 12):
        place.put(NAME % day, day)
    assert place.load(load_id="many").good == 11
    assert place.load(load_id="many").good == 11
    assert len(place.stored()) == 11
    assert len({p.name for p in (place.root / "store").glob("outcome=good/*/load_id=many*")}) > 1


def test_the_lock_is_exclusive_and_expires(place):
    path = str(place.root / "log")
    with Ledger(place.spark, path).locked():
        with pytest.raises(TimeoutError):
            with Ledger(place.spark, path).locked(patience_seconds=0.5):
                pass
        with Ledger(place.spark, path, lease_seconds=-1).locked(patience_seconds=5):
            pass
