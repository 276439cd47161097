"""Upsert tables as plain partitioned Parquet.

::

    path/rows/run=R/epoch=N/<date>=D/part-*.parquet

A batch is the pair (run, epoch). Its rows, newest per key, are written under
their own partitions with Spark's dynamic partition overwrite: a replay of the
batch replaces its own rows, and no other batch's rows are ever touched. The
reader takes the newest row of each key over all batches, so late, repeated and
replayed rows change nothing that they should not.

The run tells batches of the same number apart. Inside a stream it is the
query's id, which its checkpoint keeps: a restart goes on in the same run, and a
new checkpoint, whose epochs begin at 0 again, is a new run. Outside a stream
every call is a run of its own unless the caller names one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.operators.dedup import keep_latest
from sitecast.session import path_exists

#: Set by Spark on the thread that runs a stream's foreachBatch function.
QUERY_ID = "sql.streaming.queryId"


def current_run(spark: SparkSession) -> str:
    """The running stream's id, or a name of its own for a call outside one.
    The prefix keeps the partition value a string."""
    return f"r-{spark.sparkContext.getLocalProperty(QUERY_ID) or uuid.uuid4().hex}"


def write_batch(rows: DataFrame, path: str, run: str, epoch: int, *parts: str) -> None:
    """Replace the rows of one (run, epoch) below ``path``. Rows are rebalanced by
    ``parts`` first: few files for small dates, several for large ones."""
    if parts:
        rows = rows.hint("rebalance", *parts)
    (rows.withColumn("run", F.lit(run)).withColumn("epoch", F.lit(int(epoch)).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run", "epoch", *parts).parquet(path))


class UpsertTable:
    """Rows with ``keys``, of which the one with the greatest ``order`` tuple
    counts, partitioned by the date ``part`` that ``part_of()`` computes."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str],
                 part: str, part_of: Callable[[], Column]):
        self.spark, self.path = spark, path
        self.keys, self.order, self.part, self.part_of = keys, order, part, part_of

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/rows")

    def upsert(self, rows: DataFrame, epoch: int = 0, run: str | None = None) -> None:
        """Add the batch's rows; ``run`` defaults to ``current_run``."""
        newest = keep_latest(rows, self.keys, self.order).withColumn(self.part, self.part_of())
        write_batch(newest, f"{self.path}/rows", run or current_run(self.spark), epoch, self.part)

    def read(self, where: Column | None = None) -> DataFrame:
        """The newest row of each key; ``where`` on the date reads the partitions
        of those dates only. A key has one date, so no newer row is missed."""
        if not self.exists():
            raise FileNotFoundError(f"no rows below {self.path}")
        rows = self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/rows").drop("run", "epoch")
        return keep_latest(rows if where is None else rows.where(where), self.keys, self.order)
