"""Files that arrive in a folder become snapshots, batch after batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import identifier
from orderloom.plans.ingest import GateError, ingest
from orderloom.schemas import DEFAULT_REJECT_RATE_LIMIT
from orderloom.sources.store import Store

#: Files of a batch at most; their names come to the driver.
MAX_FILES = 1000


def snapshot_name(name: str, batch: int) -> str:
    """The snapshot that a batch becomes. The stream's checkpoint fixes which files a batch holds,
    so a repeated batch is the same snapshot."""
    return identifier(f"{name}-{batch:06d}")


def follow(
    store: Store,
    folder: str,
    name: str,
    limit: float = DEFAULT_REJECT_RATE_LIMIT,
    max_files: int = MAX_FILES,
    stop_at_refused: bool = True,
) -> None:
    """Ingest all files of ``folder`` that this stream has not seen yet, and return.

    Each batch of at most ``max_files`` files becomes the snapshot ``<name>-<batch>``; only complete
    files may appear in the folder. The stream's progress is kept below the root. After a crash
    the interrupted batch runs again under its own name: what was finished is returned as stored,
    what was landed is resumed. A refused batch stops the stream, which meets it again at every
    start until another stream name is taken; with ``stop_at_refused`` unset its evidence stays and
    the next batches go on.
    """
    files = store.spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(folder)

    def take(batch: DataFrame, number: int) -> None:
        # One name per file: the splits of a file agree in it.
        paths = sorted(row[0] for row in batch.select("path").distinct().collect())
        try:
            ingest(store, paths, snapshot_name(name, number), limit=limit)
        except GateError:
            if stop_at_refused:
                raise

    query = (
        files.select(F.col("_metadata.file_path").alias("path"))
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{store.root}/_arrivals/{identifier(name)}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
