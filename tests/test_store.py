"""The window store: many refreshes, late samples, folds, and repeats after a failure."""

from collections import defaultdict
from datetime import timedelta
from random import Random

import pytest
from records import at, records

import roadpulse.streaming.store as store_module
from roadpulse.schema import SPEED_INPUT
from roadpulse.streaming.store import late_samples, start_window_store, stored_windows


class Store:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def refresh(self, *rows, **options):
        """One more file of (driver, minutes after the start, speed, overspeed), and one refresh."""
        samples = records(self.spark, *[
            {"driverID": d, "record_time": t and at("2017-01-01 00:00") + timedelta(minutes=t), "speed": s, "isOverspeed": o}
            for d, t, s, o in rows
        ]).select(*SPEED_INPUT)
        samples.coalesce(1).write.mode("append").parquet(str(self.root / "in"))
        stream = self.spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).parquet(str(self.root / "in"))
        names = (str(self.root / n) for n in ("windows", "checkpoint"))
        start_window_store(stream, *names, trigger=None, **options).awaitTermination()

    def windows(self):
        rows = stored_windows(self.spark, str(self.root / "windows")).collect()
        return {(r.driverID, r.window_start): (r.n_points, r.n_late, r.max_speed, r.is_overspeed) for r in rows}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, tmp_path)


def brute(refreshes):
    """Windows by hand; late means a minute behind the newest time of earlier refreshes."""
    found, newest = defaultdict(lambda: [0, 0, 0, False]), None
    for rows in refreshes:
        for driver, minute, speed, over in rows:
            if minute is None:
                continue
            w = found[driver, at("2017-01-01 00:00") + timedelta(minutes=minute // 3 * 3)]
            w[0] += 1
            w[1] += newest is not None and minute < newest - 1
            w[2] = max(w[2], speed or 0)
            w[3] = w[3] or bool(over)
        newest = max([m for _, m, _, _ in rows if m is not None] + ([newest] if newest is not None else []), default=None)
    return {k: tuple(v) for k, v in found.items()}


def test_many_refreshes_equal_brute_force_and_few_files_are_read(spark, store):
    draw, refreshes = Random(2), []
    for n in range(11):
        now = 400 * n
        rows = [(draw.choice(["a", "b", None]), draw.choice([now, now + 1, now - 1, now - 700]), draw.choice([5, 90, None]), draw.choice([True, False, None]))
                for _ in range(8)]
        refreshes.append([(d, max(m, 1), s, o) for d, m, s, o in rows] + [("a", None, 3, True)])
        store.refresh(*refreshes[-1], fold_every=4)
        if n in (0, 3, 6):
            assert store.windows() == brute(refreshes)
    assert store.windows() == brute(refreshes)
    late = late_samples(spark, str(store.root / "windows"))
    assert late.count() == sum(v[1] for v in brute(refreshes).values()) > 0
    # Eight of eleven refreshes are folded: three stay, and one folder a day.
    assert len(list((store.root / "windows" / "delta").glob("batch_id=*"))) == 3
    days = list((store.root / "windows" / "snapshot").glob("day=*"))
    assert all(len(list(d.glob("upto=*"))) == 1 for d in days)
    assert len(stored_windows(spark, str(store.root / "windows")).inputFiles()) <= 3 * 4 + 4 * len(days)


@pytest.mark.parametrize("moment", ["_replace", "_merged", "remove_folder"])
def test_a_repeated_refresh_counts_once(store, monkeypatch, moment):
    rows = [[("a", 1, 10, False), ("b", 5, 20, True)], [("a", 900, 1, None)], [("a", 1, 70, True), ("a", 1500, 2, False)]]
    for part in rows[:2]:
        store.refresh(*part, fold_every=3)
    real, calls = getattr(store_module, moment), []

    def late_crash(*args):
        calls.append(args)
        result = real(*args)
        if len(calls) >= (2 if moment == "_replace" else 1):
            raise RuntimeError("driver lost")
        return result

    monkeypatch.setattr(store_module, moment, late_crash)
    with pytest.raises(Exception, match="driver lost"):
        store.refresh(*rows[2], fold_every=3)
    monkeypatch.setattr(store_module, moment, real)
    store.refresh(("c", 1501, None, None), fold_every=3)
    assert store.windows() == brute([*rows, [("c", 1501, None, None)]])


def test_an_empty_store(spark, tmp_path):
    assert stored_windows(spark, str(tmp_path / "none")).collect() == []
    assert late_samples(spark, str(tmp_path / "none")).collect() == []
