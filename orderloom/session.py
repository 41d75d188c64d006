"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that results depend on; safe to set on a session someone else made.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated key inside one JSON object keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to an existing session."""
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app_name: str = "orderloom", **conf) -> SparkSession:
    """Make a session with result and scale settings; ``conf`` adds or overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SCALE_SETTINGS, **RESULT_SETTINGS, "spark.ui.enabled": "false", **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="orderloom-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


#: Compression of what is stored: JSON texts and hashes take half of what the default leaves.
STORED = "zstd"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives lost executors and, unlike a cache, lets later readers
    prune columns.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", STORED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stored_meanwhile(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """As ``materialize``, for a table that nothing reads after the block; it is deleted then."""
    stored = materialize(df, label)
    try:
        yield stored
    finally:
        discard(stored)


def discard(stored: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` wrote."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored.inputFiles()[0]).getParent()
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle rows ahead of CPU-heavy work only when the scan has too few tasks.

    A small file holds few row groups and would keep most cores idle; a large table has
    more tasks than cores already and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


#: Folders that one task writes at the same time.
MAX_OPEN_FOLDERS = 200


@contextmanager
def unsorted_folders(spark: SparkSession) -> Iterator[None]:
    """Let tasks that write rows to several folders keep these open instead of sorting the rows."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(MAX_OPEN_FOLDERS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# Stored bytes per shuffle task; rows take several times as much in memory.
BYTES_PER_TASK = 64 * 1024 * 1024
MAX_SHUFFLE_TASKS = 100_000


def stored_bytes(df: DataFrame) -> int:
    """About how many stored bytes the rows of a frame take, by the files it reads."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


@contextmanager
def shuffles_for(df: DataFrame) -> Iterator[None]:
    """Raise the number of shuffle tasks to what the size of ``df``'s files calls for.

    Adaptive execution merges small shuffle partitions but never splits plain ones up, so
    a large input needs enough of them from the start. The setting is restored at the end.
    """
    conf, key = df.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    wanted = min(stored_bytes(df) // BYTES_PER_TASK + 1, MAX_SHUFFLE_TASKS)
    conf.set(key, str(max(int(before), wanted)))
    try:
        yield
    finally:
        conf.set(key, before)
