"""The history table and its upsert.

A batch is deduplicated and written under its run and epoch
(``sitecast.sources.upserts``); rows without a key go to the table's rejects. The
reader keeps the newest row of each key and derives the slot statistics and the
quality flag, so late rows correct the statistics of their slot.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.functions.columns import quality_flag
from sitecast.operators.dedup import keep_latest
from sitecast.operators.joins import lookup_join
from sitecast.operators.stats import slot_aggregates
from sitecast.schema import KEY, NEWEST
from sitecast.session import path_exists, scratch_path
from sitecast.sources.upserts import UpsertTable, current_run, write_batch

DATE_COL = "measurement_date"
HISTORY_COLUMNS = ["event_id", "site_id", "measurement_time", "modified_time",
                   "vehicle_flow_rate", "average_vehicle_speed", "specific_lane",
                   "geometry", "data_quality"]


def table(spark: SparkSession, path: str, keys: Sequence[str] = KEY, order: Sequence[str] = NEWEST) -> UpsertTable:
    return UpsertTable(spark, path, keys, order, DATE_COL, lambda: F.to_date("measurement_time"))


def _with_stats(df: DataFrame) -> DataFrame:
    if "avg_vehicle_flow_rate" not in df.columns:
        df = lookup_join(df, slot_aggregates(df), "measurement_time", "left")
    return df.withColumn("data_quality_categorical", quality_flag())


def split_batch(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a key, and the rejects (a null key is not merged)."""
    has_key = F.col("site_id").isNotNull() & F.col("measurement_time").isNotNull()
    cols = [c for c in HISTORY_COLUMNS if c in batch.columns]
    return batch.where(has_key).select(*cols), batch.where(~has_key).select(*cols)


def upsert(spark: SparkSession, batch: DataFrame, path: str, epoch_id: int = 0,
           keys: Sequence[str] = KEY, order: Sequence[str] = NEWEST,
           stats_scope: str = "merged", run: str | None = None) -> None:
    """Merge one batch, the pair (``run``, ``epoch_id``): by default every call
    outside a stream is a run of its own, so no call replaces another's rows.
    ``stats_scope="batch"`` keeps the reference's per-batch
    statistics (computed before dedup, duplicates counted) in the rows; the
    default derives them from the merged rows when they are read."""
    good, bad = split_batch(batch)
    if stats_scope == "batch":
        good = lookup_join(keep_latest(good, keys, order), slot_aggregates(good), "measurement_time", "left")
    run = run or current_run(spark)
    table(spark, path, keys, order).upsert(good, epoch_id, run)
    write_batch(bad, f"{path}/rejects", run, epoch_id)


def read_history(spark: SparkSession, path: str, since: dt.date | None = None, stats: bool = True,
                 keys: Sequence[str] = KEY, order: Sequence[str] = NEWEST) -> DataFrame:
    """The merged rows with slot statistics; ``since`` reads the dates from it
    on only (the other partitions are pruned)."""
    where = None if since is None else F.col(DATE_COL) >= F.lit(since)
    rows = table(spark, path, keys, order).read(where)
    return _with_stats(rows) if stats else rows


def newest_slot(spark: SparkSession, path: str) -> dt.datetime | None:
    """The newest slot in the table. Merging cannot change it, so one column of
    the stored rows is enough."""
    if not path_exists(spark, f"{path}/rows"):
        return None
    return spark.read.parquet(f"{path}/rows").agg(F.max("measurement_time")).first()[0]


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rows that were not merged because they have no key."""
    return spark.read.option("mergeSchema", "true").parquet(f"{path}/rejects").drop("run", "epoch")


def overlapping_batches(readings: DataFrame, n_batches: int = 3, overlap: float = 0.5) -> list[DataFrame]:
    """Cut readings into ``n`` consecutive time ranges of the delivery time,
    each stretched by ``overlap`` of a range into the next one, so rows are
    delivered more than once (as the reference's 20-minute pulls every
    minute do)."""
    lo, hi = readings.agg(F.min("modified_time"), F.max("modified_time")).first()
    span = (hi - lo) / n_batches
    out = []
    for i in range(n_batches):
        start = lo + span * i
        end = lo + span * (i + 1 + overlap)
        cond = F.col("modified_time") >= F.lit(start)
        if i < n_batches - 1:
            cond = cond & (F.col("modified_time") < F.lit(end))
        out.append(readings.where(cond))
    return out


def q_upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three overlapping deliveries and a replay of the first, merged
    into a fresh history table; the result equals a one-shot dedup."""
    from sitecast.sources.tables import readings
    r = readings(spark, sf_dir)
    path = scratch_path(spark, "history")
    batches = overlapping_batches(r)
    for b in batches + batches[:1]:
        upsert(spark, b, path)
    return read_history(spark, path)


HISTORY_QUERIES = {"upsert_merge": q_upsert_merge}
