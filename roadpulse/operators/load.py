"""Writing telemetry: idempotent appends to the month table and whole-folder loads."""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.parse import is_good, parse_telemetry, with_shard
from roadpulse.schema import TELEMETRY_COLUMNS
from roadpulse.session import prunable_times
from roadpulse.sources.files import list_files, literal_path, read_lines
from roadpulse.sources.ledger import Ledger
from roadpulse.sources.table import is_not_found

_REJECT_COLUMNS = ["file_name", "line", "reject_reasons"]
_REJECTS = (
    "file_name string, line string, reject_reasons array<string>, shard string, load_id string"
)


@dataclass(frozen=True)
class LoadReport:
    """Lines seen by a load, and how many were stored or rejected."""

    load_id: str
    seen: int
    good: int
    rejected: int
    #: Good and rejected lines by file, where the load was told its files.
    files: dict[str, tuple[int, int]] = field(default_factory=dict, compare=False, repr=False)


def _replace_load(df: DataFrame, path: str, load_id: str, *partitions: str) -> None:
    (
        df.withColumn("load_id", F.lit(load_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, "load_id")
        .parquet(path)
    )


def _store(df: DataFrame, path: str, load_id: str, *partitions: str) -> None:
    ordered = df.sortWithinPartitions(*partitions, "driverID", "record_time")
    with prunable_times(df.sparkSession):
        _replace_load(ordered, path, load_id, *partitions)


def append_telemetry(
    df: DataFrame, path: str, load_id: str | None = None, gather: bool = False
) -> str:
    """Append records (with ``shard``) to a month table; returns the load's id.

    A load owns its ``shard=…/load_id=…`` folders: running it again under the same
    id replaces them, so a failed or repeated load neither loses nor doubles rows.
    Files are sorted by driver and time, so that both kinds of filter skip pages.

    Without ``gather`` nothing is shuffled and a task writes the months of its own
    input: right for uploads, which hold one month each. With it records are first
    brought together by month, for input that has every month everywhere; adaptive
    execution cuts a large month into many evenly sized files.
    """
    load_id = load_id or uuid.uuid4().hex
    stored = df.select(*TELEMETRY_COLUMNS, "shard")
    _store(stored.hint("rebalance", "shard") if gather else stored, path, load_id, "shard")
    return load_id


def table_path(store: str) -> str:
    """The month table inside a store written by loads."""
    return f"{store}/outcome=good"


def read_rejects(spark: SparkSession, store: str) -> DataFrame:
    """Rejected lines of all loads, with the file and the reasons."""
    try:
        return spark.read.schema(_REJECTS).parquet(f"{store}/outcome=rejected")
    except AnalysisException as error:
        if not is_not_found(error):
            raise
        return spark.createDataFrame([], _REJECTS)


def _line_counts(spark: SparkSession, file_names: list[str]) -> tuple[list[Column], dict[int, str]]:
    """Aggregates that count good and rejected lines of each file, and which number stands for which file.

    A histogram with a bin for every distinct value loses none, and unlike a grouping it can be
    observed while rows are written. Values are hashes of the names, whole numbers that differ between the
    files of one load (checked here).
    """
    good = F.col("outcome") == "good"
    names, seed, numbers = sorted(set(file_names)), 0, {}
    while len(numbers) < len(names):
        number = F.pmod(F.xxhash64(F.lit(seed), "counted_file"), F.lit(1 << 30))
        listed = spark.createDataFrame([(n,) for n in names], "counted_file string")
        numbers, seed = {r[1]: r[0] for r in listed.select("counted_file", number).collect()}, seed + 1
    value, bins = number.cast("double"), F.lit(max(2, len(names)))
    return [
        F.histogram_numeric(F.when(good, value), bins).alias("good_by_file"),
        F.histogram_numeric(F.when(~good, value), bins).alias("rejected_by_file"),
    ], numbers


def _by_file(histogram: list | None, numbers: dict[int, str]) -> Counter:
    """Lines by file. Merged bins are means of equal values, which may be off by a rounding."""
    found = Counter()
    for bin_ in histogram or []:
        found[numbers[round(bin_.x)]] += round(bin_.y)
    return found


def load_lines(
    lines: DataFrame,
    store: str,
    load_id: str | None = None,
    route: str = "file_name",
    file_names: list[str] | None = None,
) -> LoadReport:
    """Parse lines and write good records and rejects in one pass over the input.

    One job writes both below ``store``, as ``outcome=good`` (the month table) and
    ``outcome=rejected``, and counts the rows as it writes them: after any shuffle,
    so that every line is counted by exactly one successful task, whatever
    executors are lost. If ``file_names`` names the files of the lines, the same pass counts by file.
    """
    load_id = load_id or uuid.uuid4().hex
    parsed = with_shard(parse_telemetry(lines), route)
    kept_if_bad = [F.when(~is_good(), F.col(c)).alias(c) for c in _REJECT_COLUMNS]
    outcome = F.when(is_good(), "good").otherwise("rejected").alias("outcome")
    counted_file = [F.col("file_name").alias("counted_file")] if file_names else []
    rows = parsed.select(*TELEMETRY_COLUMNS, *kept_if_bad, outcome, "shard", *counted_file)
    if route == "record_time":
        rows = rows.hint("rebalance", "outcome", "shard")
    good = F.col("outcome") == "good"
    counts = Observation(f"load {load_id} {uuid.uuid4().hex}")
    by_file, numbers = _line_counts(lines.sparkSession, file_names) if file_names else ([], {})
    counted = rows.observe(
        counts,
        F.count("*").alias("seen"),
        F.count_if(good).alias("good"),
        F.count_if(~good).alias("rejected"),
        *by_file,
    )
    _store(counted.drop("counted_file"), store, load_id, "outcome", "shard")
    found = counts.get
    good_of, rejected_of = (_by_file(found.get(f"{kind}_by_file"), numbers) for kind in ("good", "rejected"))
    files = {n: (good_of[n], rejected_of[n]) for n in file_names or []}
    return LoadReport(load_id, found["seen"], found["good"], found["rejected"], files)


def load_log(spark: SparkSession, log: str) -> DataFrame:
    """Uploads of completed loads, each with the counts of its own lines."""
    return Ledger(spark, log).completed().select("file_name", "seen", "good", "rejected", "load_id")


def refused_uploads(spark: SparkSession, log: str) -> DataFrame:
    """Uploads that were not loaded, with the reason: an admission rule, ``duplicate`` or ``changed``."""
    return Ledger(spark, log).refused()


def load_uploads(
    ledger: Ledger, files: DataFrame, store: str, load_id: str, route: str, settle_seconds: float = 0
) -> LoadReport:
    """Claim the uploads of a listing that no load has, and store them; both loads come through here."""
    if not ledger.claim(files, load_id, route, settle_seconds):
        return LoadReport(load_id, 0, 0, 0)
    return finish_load(ledger, store, load_id)


def finish_load(ledger: Ledger, store: str, load_id: str) -> LoadReport:
    """Store the files that a pending load wrote down, and enter it as completed.

    Nothing else of the folder is opened. Files are read in chunks, whose parts of the load replace
    themselves, so this may be repeated from the start at any time until the entry is gone. The log is
    written before the entry goes; a load found in both has only its entry removed.
    """
    done = ledger.completed().filter(F.col("load_id") == load_id)
    if done.isEmpty():
        entry = ledger.pending().filter(F.col("load_id") == load_id)
        uploads = entry.groupBy("upload").agg(
            *[F.first(c).alias(c) for c in ("file_name", "file_size", "chunk", "route")], F.collect_list("file_path").alias("paths")
        )
        counts = []
        for (chunk,) in sorted(entry.select("chunk").distinct().collect()):
            part = uploads.filter(F.col("chunk") == chunk).collect()
            lines = read_lines(ledger.spark, [literal_path(p) for u in part for p in u.paths])
            part_id = f"{load_id}.{chunk}" if chunk else load_id
            report = load_lines(lines, store, part_id, part[0].route, [u.file_name for u in part])
            counts += [
                (u.file_name, sum(report.files[u.file_name]), *report.files[u.file_name], u.upload, u.file_size) for u in part
            ]
        rows = "file_name string, seen bigint, good bigint, rejected bigint, upload string, file_size bigint"
        _replace_load(ledger.spark.createDataFrame(counts, rows).coalesce(1), ledger.path, load_id)
    ledger.release("_pending", load_id)
    return _recorded(ledger, load_id)


def _recorded(ledger: Ledger, load_id: str) -> LoadReport | None:
    """The report of a completed load, or None."""
    totals = [F.sum(c).alias(c) for c in ("seen", "good", "rejected")]
    done = ledger.completed().filter(F.col("load_id") == load_id).agg(*totals).first()
    return None if done.seen is None else LoadReport(load_id, done.seen, done.good, done.rejected)


def finish_abandoned(ledger: Ledger, store: str, lease_seconds: float) -> list[LoadReport]:
    """Finish loads that were claimed and not completed: by this application, or long ago by another."""
    return [finish_load(ledger, store, load_id) for load_id in ledger.unfinished(lease_seconds)]


def load_folder(
    spark: SparkSession,
    folder: str,
    store: str,
    log: str,
    load_id: str | None = None,
    route: str = "file_name",
    settle_seconds: float = 0,
    lease_seconds: float = 3600,
) -> LoadReport:
    """Load the admitted uploads of a folder whose names no load has taken.

    The ledger under ``log`` is the same as that of :func:`ingest_stream`. The files of the load are written
    down before anything is stored, and only they are opened; files that arrive meanwhile wait for the next
    load. A load that a lost driver left behind is finished first, under its own id and with its own files, and counts in
    the report. A ``load_id`` that is already completed only returns its report. Uploads with a part younger than
    ``settle_seconds`` wait.
    """
    ledger = Ledger(spark, log)
    finished = finish_abandoned(ledger, store, lease_seconds)
    if load_id is not None and (done := _recorded(ledger, load_id)) is not None:
        return done
    load_id = load_id or uuid.uuid4().hex
    reports = [*finished, load_uploads(ledger, list_files(spark, folder), store, load_id, route, settle_seconds)]
    return LoadReport(load_id, *(sum(getattr(r, c) for r in reports) for c in ("seen", "good", "rejected")))
