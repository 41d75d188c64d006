"""Shared helpers: columns by position, tables in the shared folder, broadcasts of checked size."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import shared_folder

#: Rows up to which a narrow table is broadcast; beyond it the join is a shuffle.
BROADCAST_ROWS = 50_000


class Positions:
    """A frame whose columns are named by position, so no input name can clash with ours.

    ``self[name]`` is the first column of exactly that name; ``restore`` gives the input
    names back.
    """

    def __init__(self, rows: DataFrame):
        self.names = rows.columns
        self.inner = [f"in{i}" for i in range(len(self.names))]
        self.rows = rows.toDF(*self.inner)

    def __getitem__(self, name: str) -> Column:
        return F.col(self.inner[self.names.index(name)])

    def pick(self, *names: str) -> DataFrame:
        return self.rows.select(*[self[name].alias(name) for name in names])

    def restore(self, rows: DataFrame, **replaced: Column) -> DataFrame:
        """``rows`` (which still has our inner columns) under the input's names; ``replaced``
        gives new content for some of them."""
        first = {name: self.names.index(name) for name in replaced}
        return rows.select(
            *[
                replaced[name].alias(inner) if first.get(name) == i else F.col(inner)
                for i, (name, inner) in enumerate(zip(self.names, self.inner, strict=True))
            ]
        ).toDF(*self.names)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written as a table to the shared folder and read again: cuts the lineage, and
    survives the loss of executors."""
    path = new_path(rows.sparkSession, name)
    rows.write.parquet(path)
    staged = rows.sparkSession.read.schema(rows.schema).parquet(path)
    staged.stage_path = path
    return staged


def discard(rows: DataFrame) -> None:
    """Delete a table that ``stage`` made and that no later step reads."""
    spark, path = rows.sparkSession, rows.stage_path
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def is_short(rows: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether a narrow table has at most ``most`` rows."""
    return rows.limit(most + 1).count() <= most


def few(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` to be broadcast if they are few, and otherwise as they are, for a shuffled join
    whose skewed partitions the runtime splits. ``rows`` should be a staged table."""
    return F.broadcast(rows) if is_short(rows, most) else rows
