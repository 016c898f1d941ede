"""The ledger of uploads: which names are taken, being loaded, held back or refused.

A ledger is a folder on storage that every driver sees. Its visible files are the log of completed
loads; hidden folders beside them hold what is under way::

    load_id=…            completed: one row for each upload, with its counts
    _pending/load_id=…   claimed: the files of a load, written before anything is stored
    _refused/load_id=…   uploads that were turned away, and why
    _held/load_id=…      uploads whose parts may still be arriving
    _lock                exists while one driver decides what it may load

Names are decided under the lock, against completed and pending loads alike, so an upload name is stored
once however it arrives. Everything after that runs without the lock and is repeatable: a
pending load is finished by whoever finds it, under the id and with the files written down.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.session import remove_folder
from roadpulse.sources.files import admit_files

LOG = "file_name string, seen bigint, good bigint, rejected bigint, load_id string"
_DONE = LOG + ", upload string, file_size bigint"
_PENDING = ("file_path string, file_name string, upload string, file_size bigint, chunk int, "
            "route string, owner string, load_id string")
REFUSED = "file_name string, upload string, file_size bigint, reason string, load_id string"
_HELD = "upload string, load_id string"

# Reasons beside the admission rules: another upload has the name; this one changed after it was loaded.
DUPLICATE, CHANGED = "duplicate", "changed"
# Files whose paths a driver holds at once; a load of more goes in several chunks.
CHUNK_FILES = 10_000


@dataclass(frozen=True)
class Ledger:
    """The ledger under ``path``. A lock older than ``lease_seconds`` counts as left behind by a lost driver."""

    spark: SparkSession
    path: str
    lease_seconds: float = 600

    # --- reading ---

    def _read(self, name: str, schema: str) -> DataFrame:
        folder = f"{self.path}/{name}" if name else self.path
        self._make(folder)
        return self.spark.read.schema(schema).parquet(folder)

    def completed(self) -> DataFrame:
        """Uploads of completed loads with their counts."""
        return self._read("", _DONE)

    def pending(self) -> DataFrame:
        return self._read("_pending", _PENDING)

    def refused(self) -> DataFrame:
        return self._read("_refused", REFUSED)

    def held(self) -> DataFrame:
        return self._read("_held", _HELD)

    # --- deciding ---

    def claim(self, files: DataFrame, load_id: str, route: str, settle_seconds: float = 0) -> bool:
        """Decide on the uploads of ``files`` and write down which this load will store; whether there are any.

        ``files`` is a listing (path, file_name, file_size, upload, modified). Of uploads that share a name
        the one that came first is taken. Uploads with a part younger than ``settle_seconds`` are held
        for a later load. Nothing is decided twice: a completed upload is passed over, or
        refused as changed if its size is another, and refusals are written down once.
        """
        with self.locked():
            fresh = self._undecided(files, settle_seconds)
            self._append(fresh["held"], "_held", load_id)
            self._append(fresh["refused"], "_refused", load_id)
            taken = fresh["taken"].cache()
            try:
                number = taken.count()
                chunks = max(1, -(-number // CHUNK_FILES))
                chunk = F.pmod(F.xxhash64("upload"), F.lit(chunks)).cast("int")
                owner = self.spark.sparkContext.applicationId
                entry = taken.select(
                    F.col("path").alias("file_path"), "file_name", "upload", "file_size", chunk.alias("chunk"),
                    F.lit(route).alias("route"), F.lit(owner).alias("owner"),
                )
                if number:
                    self._append(entry, "_pending", load_id)
            finally:
                taken.unpersist()
        return number > 0

    def _undecided(self, files: DataFrame, settle_seconds: float) -> dict[str, DataFrame]:
        """Files to take, uploads to refuse and uploads to hold."""
        uploads = files.groupBy("upload", "file_name").agg(
            F.max("file_size").alias("file_size"), F.min("modified").alias("first"), F.max("modified").alias("last")
        )
        loaded = self.completed().select("upload", F.col("file_size").alias("loaded_size"))
        claimed = self.pending().select("upload").distinct().withColumn("claimed", F.lit(True))
        known = uploads.join(loaded, "upload", "left").join(claimed, "upload", "left").filter("claimed is null")
        young = F.col("last") > F.current_timestamp() - F.make_dt_interval(secs=F.lit(float(settle_seconds)))
        waiting = F.lit(settle_seconds > 0) & young & F.col("loaded_size").isNull()
        names = self.completed().select("file_name").unionAll(self.pending().select("file_name")).distinct()
        judged = admit_files(known.withColumn("held", waiting)).join(
            names.withColumn("used", F.lit(True)), "file_name", "left"
        )
        changed = F.when(F.col("loaded_size") != F.col("file_size"), CHANGED)
        reason = F.when(F.col("loaded_size").isNotNull(), changed).otherwise(
            F.coalesce("reason", F.when(F.col("used"), DUPLICATE))
        )
        judged = judged.withColumn("reason", reason).filter("loaded_size is null or reason is not null")
        candidates = judged.filter("reason is null and not held")
        first = candidates.groupBy("file_name").agg(F.min_by("upload", F.struct("first", "upload")).alias("upload"))
        later = candidates.join(first, ["file_name", "upload"], "left_anti").withColumn("reason", F.lit(DUPLICATE))
        turned_away = judged.filter("reason is not null").unionByName(later)
        columns = ["file_name", "upload", "file_size", "reason"]
        return {
            "taken": files.join(first, ["file_name", "upload"], "left_semi"),
            "refused": turned_away.select(columns).join(self.refused().select(columns), columns, "left_anti"),
            "held": judged.filter("reason is null and held").select("upload"),
        }

    # --- finishing ---

    def unfinished(self, lease_seconds: float) -> list[str]:
        """Pending loads of this application, and of others that were claimed ``lease_seconds`` ago."""
        entries = self.pending().select(
            "load_id", "owner", F.col("_metadata.file_modification_time").alias("claimed")
        )
        mine = F.col("owner") == self.spark.sparkContext.applicationId
        old = F.col("claimed") < F.current_timestamp() - F.make_dt_interval(secs=F.lit(float(lease_seconds)))
        return [r.load_id for r in entries.filter(mine | old).select("load_id").distinct().orderBy("load_id").collect()]

    def release(self, name: str, load_id: str) -> None:
        """Remove an entry that is done."""
        remove_folder(self.spark, f"{self.path}/{name}/load_id={load_id}")

    def _append(self, rows: DataFrame, name: str, load_id: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/load_id={load_id}")

    # --- the lock ---

    @contextmanager
    def locked(self, patience_seconds: float = 3600) -> Iterator[None]:
        """Hold the ledger's lock, a file that only one driver can create."""
        files, path = self._files(f"{self.path}/_lock")
        self._make(self.path)
        until = time.monotonic() + patience_seconds
        while not self._created(files, path):
            if time.monotonic() > until:
                raise TimeoutError(f"{path} is held by another load")
            time.sleep(0.2)
        try:
            yield
        finally:
            files.delete(path, False)

    def _created(self, files, path) -> bool:
        from py4j.protocol import Py4JJavaError

        try:
            files.create(path, False).close()
            return True
        except Py4JJavaError:
            if not files.exists(path):
                return False
            age = time.time() - files.getFileStatus(path).getModificationTime() / 1000
            if age > self.lease_seconds:
                files.delete(path, False)
            return False

    def _files(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _make(self, path: str) -> None:
        files, target = self._files(path)
        files.mkdirs(target)
