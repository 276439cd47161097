"""Slot statistics, latest slot, batch metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.functions.columns import quality_flag, round6
from sitecast.operators.joins import lookup_join


def slot_aggregates(df: DataFrame, time: str = "measurement_time",
                    value: str = "vehicle_flow_rate") -> DataFrame:
    """A1/A2 fused: per slot mean and *sample* standard deviation (null for a
    single reading) in one aggregate with map-side combine, so a slot holding
    a third of the rows is pre-reduced in every input task."""
    v = F.col(value)
    return df.groupBy(time).agg(
        round6(F.avg(v)).alias("avg_vehicle_flow_rate"),
        round6(F.stddev_samp(v)).alias("std_vehicle_flow_rate"))


def slot_stats(df: DataFrame, time: str = "measurement_time",
               value: str = "vehicle_flow_rate", drop=("modified_time",)) -> DataFrame:
    """J1 + P4 + P5: quality flag, drop columns, then the slot mean/std joined
    back to every reading; null slots match nothing.

    One aggregate and one left join (the reference runs two of each). The
    aggregate (one row per slot) is broadcast after its size is checked, so
    the readings are not shuffled; past the bound it is a shuffle join whose
    skewed partitions AQE splits.
    """
    base = df.withColumn("data_quality_categorical", quality_flag()).drop(*drop)
    return lookup_join(base, slot_aggregates(df, time, value), on=time, how="left")


def latest_slot(d: DataFrame, site: str = "site_id", time: str = "measurement_time") -> DataFrame:
    """Newest slot per site and overall (scalar subquery, no join)."""
    overall = d.agg(F.max(F.col(time))).scalar()
    return d.groupBy(site).agg(F.max(F.col(time)).alias("latest_time"),
                               F.count(F.lit(1)).alias("n_readings")
                               ).withColumn("overall_latest", overall)


def batch_metrics(df: DataFrame, batch_col: str) -> DataFrame:
    """Rows and columns of each pull/batch."""
    n_cols = len([c for c in df.columns if c != batch_col])
    return df.groupBy(batch_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.lit(n_cols).alias("n_columns"))


def observed_metrics(df: DataFrame, name: str = "batch"):
    """S8 without an extra job: ``df.observe`` counts rows while the batch
    is written. Returns (observed DataFrame, Observation)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n_rows")), obs
