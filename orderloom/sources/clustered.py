"""A landing clustered by update time, so that a window reads few files."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orderloom.operators import windows

#: Rows of a file at most; a month of more rows is several files, each of one stretch of time.
FILE_ROWS = 5_000_000
_MONTH = "update_month"


def write_clustered(rows: DataFrame, path: str, column: str = "updated_at") -> None:
    """Write ``rows`` by month of ``column``, sorted by it within each file.

    The runtime splits large months by ranges of the sort and joins small ones into tasks. Rows
    without a time stand in a month of their own.
    """
    month = F.date_format(column, "yyyy-MM")
    (
        rows.withColumn(_MONTH, month)
        .repartitionByRange(column)
        .sortWithinPartitions(column)
        .write.option("maxRecordsPerFile", FILE_ROWS)
        .partitionBy(_MONTH)
        .parquet(path)
    )


def read_clustered(
    spark: SparkSession, path: str, schema: StructType, window: dict, column: str = "updated_at"
) -> DataFrame:
    """Rows of a clustered landing inside a window.

    The months of the window prune folders while planning, its bounds prune row groups by their
    statistics, and the rest is filtered row by row.
    """
    whole = StructType([*schema.fields, StructField(_MONTH, StringType())])
    stored = spark.read.schema(whole).parquet(path)
    upper = datetime.fromisoformat(window["upper"])
    if window["mode"] == "backfill":
        upper -= timedelta(microseconds=1)
    months = F.col(_MONTH) <= F.lit(f"{upper:%Y-%m}")
    if window.get("lower"):
        lower = datetime.fromisoformat(window["lower"])
        months = months & (F.col(_MONTH) >= F.lit(f"{lower:%Y-%m}"))
    return windows.read_window(stored.filter(months), window, column).drop(_MONTH)


def folders_read(rows: DataFrame) -> int:
    """How many folders the scans of a plan list, after pruning."""
    leaves = rows._jdf.queryExecution().sparkPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(
        len(scan.selectedPartitions().toPartitionArray()) and scan.selectedPartitions().partitionCount()
        for scan in scans
        if scan.nodeName().startswith("Scan parquet")
    )
