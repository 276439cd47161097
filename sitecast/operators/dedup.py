"""Deduplication, last-write-wins and unions."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitecast.schema import KEY, NEWEST


def keep_latest(df: DataFrame, keys: Sequence[str] = KEY,
                order: Sequence[str] = NEWEST) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (nulls
    lowest, as ``ORDER BY ... DESC NULLS LAST``).

    ``row_number() = 1`` rather than an aggregate: Catalyst plans a partial
    WindowGroupLimit *before* the shuffle, so every input task keeps only its
    newest row per key and a key holding a third of all rows is collapsed
    map-side; and unlike ``max_by(struct(...))`` it lets column pruning reach
    the scan. ``order`` must be total (end with a unique column) for a
    deterministic result.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_latest(readings: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """The newest delivery of each ``(site_id, measurement_time)``;
    newest = greatest ``modified_time``, ties broken by ``event_id``. The key
    is a parameter (add ``specific_lane`` to keep lanes apart)."""
    return keep_latest(readings, keys, NEWEST)


def keep_last_version(df: DataFrame,
                      keys: Sequence[str] = ("measurement_time", "site_id", "forecast_type"),
                      version_col: str = "version") -> DataFrame:
    """Per key keep the row of the highest version (last write wins)."""
    return keep_latest(df, keys, (version_col,))


def union_all(dfs: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), list(dfs))
