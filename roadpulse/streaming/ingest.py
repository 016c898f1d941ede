"""Drop-folder ingest: uploads are loaded once each, as they arrive."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators.load import finish_abandoned, finish_load, load_uploads
from roadpulse.sources.files import list_files, literal_path, stream_files, upload_path
from roadpulse.sources.ledger import CHUNK_FILES, Ledger


def ingest_stream(
    spark: SparkSession,
    folder: str,
    store: str,
    checkpoint: str,
    trigger: str | None = None,
    max_bytes: int | None = None,
    route: str = "file_name",
    log: str | None = None,
    settle_seconds: float = 0,
    lease_seconds: float = 3600,
) -> StreamingQuery:
    """Load admitted uploads of ``folder`` into the store, and keep watching it.

    The stream is one of file paths: the checkpoint remembers which it has shown. A new path stands for its
    whole upload, whose other parts are listed with it, so size is judged over all parts and all or
    none are stored. The ledger under ``log`` (by default a hidden folder of the store) decides; shared with
    :func:`load_folder`, a name is stored once through either. Refusals are written down there.

    With ``trigger`` None the query drains what is there and stops; ``max_bytes`` cuts a large backlog
    into several loads. A batch that is repeated after a failure has the same load id and finishes
    what its first attempt wrote down. Uploads with a part younger than ``settle_seconds`` are held until a later batch
    or start.
    """
    ledger = Ledger(spark, log or f"{store}/_uploads")
    finish_abandoned(ledger, store, lease_seconds)
    _load_paths(ledger, [], store, f"held_{uuid.uuid4().hex}", route, settle_seconds)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load_id = f"{query_id}_{batch_id}"
        own = Ledger(batch.sparkSession, ledger.path)
        if not own.pending().filter(F.col("load_id") == load_id).isEmpty():
            finish_load(own, store, load_id)
        # A batch has a bounded number of files.
        uploads = batch.select(upload_path(F.col("path"))).distinct().collect()
        _load_paths(own, [u[0] for u in uploads], store, load_id, route, settle_seconds)

    files = stream_files(spark, folder, max_bytes, CHUNK_FILES)
    writer = files.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    when = {"availableNow": True} if trigger is None else {"processingTime": trigger}
    return writer.trigger(**when).start()


def _load_paths(
    ledger: Ledger, uploads: list[str], store: str, load_id: str, route: str, settle_seconds: float
) -> None:
    """Load the uploads at some paths, and those held before."""
    before = {(r.upload, r.load_id) for r in ledger.held().collect()}
    paths = sorted({*uploads, *(upload for upload, _ in before)})
    if not paths:
        return
    load_uploads(ledger, list_files(ledger.spark, [literal_path(p) for p in paths]), store, load_id, route, settle_seconds)
    for entry in {held_by for _, held_by in before} - {load_id}:
        ledger.release("_held", entry)
