"""Per-site series features: latest N, eligibility, sliding windows, split
(W1, W3, W4, T7).

Every window here is partitioned by site and runs on deduplicated data, so
a site's partition holds at most one row per time slot: its size is bounded
by the length of the time range, not by the raw volume of readings. Raw
volume skew is absorbed earlier by the partial aggregation in dedup.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_n_per_site(d: DataFrame, n: int = 20, site: str = "site_id",
                      time: str = "measurement_time") -> DataFrame:
    """The ``n`` newest rows of each site, ``rn`` = 1 for the newest.

    ``row_number() <= n`` lets Catalyst insert a partial per-site top-n
    (WindowGroupLimit) before the shuffle, so only n rows per site and input
    task cross the network.
    """
    w = Window.partitionBy(site).orderBy(F.col(time).desc_nulls_last())
    return d.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)


def newest_rows(d: DataFrame, n: int, since: dt.datetime, site: str = "site_id",
                time: str = "measurement_time") -> DataFrame:
    """The rows from ``since`` on and, of each site, at least those of its ``n``
    newest times before it, in one pass: all that takes the newest rows of a site
    up to ``n``, or up to ``n`` before ``since``, finds them here. The rows from
    ``since`` on are all first of their site, so a partial per-site limit comes
    before the shuffle."""
    before = F.when(F.col(time) < F.lit(since).cast("timestamp_ntz"), F.col(time))
    w = Window.partitionBy(site).orderBy(before.desc_nulls_first())
    return d.withColumn("_r", F.dense_rank().over(w)).where(F.col("_r") <= n + 1).drop("_r")


def eligible_sites(d: DataFrame, min_history: int = 20, site: str = "site_id",
                   time: str = "measurement_time") -> DataFrame:
    """Sites with at least ``min_history`` distinct slots of history (the
    reference waits 20 minutes before its first forecast)."""
    return (d.groupBy(site)
            .agg(F.count_distinct(F.col(time)).alias("n_slots"))
            .where(F.col("n_slots") >= min_history))


def sliding_windows(series: DataFrame, window: int = 5, label: int = 1,
                    site: str = "site_id", time: str = "measurement_time",
                    value: str = "vehicle_flow_rate") -> DataFrame:
    """Supervised windows per site, inputs ``w1..w<window>`` (oldest
    first) and labels ``y`` (``y1..y<label>`` when label > 1).

    A site with n rows has ``n - (window + label) + 1`` windows, numbered
    ``window_id`` 0.. in time order; ``n_windows`` is carried on every row.
    ``measurement_time`` is the time of the last input, ``target_time`` the
    time of the last label.
    """
    w = Window.partitionBy(site).orderBy(F.col(time))
    v = F.col(value).cast("double")
    cols = [F.lag(v, window - 1 - i).over(w).alias(f"w{i + 1}") if i < window - 1
            else v.alias(f"w{window}") for i in range(window)]
    if label == 1:
        labels = [F.lead(v, 1).over(w).alias("y")]
    else:
        labels = [F.lead(v, j).over(w).alias(f"y{j}") for j in range(1, label + 1)]
    out = series.select(
        F.col(site), F.col(time), *cols, *labels,
        F.lead(F.col(time), label).over(w).alias("target_time"),
        F.row_number().over(w).alias("_rn"),
        F.count(F.lit(1)).over(Window.partitionBy(site)).alias("_n"))
    return (out.where((F.col("_rn") >= window) & (F.col("_rn") <= F.col("_n") - label))
            .withColumn("window_id", F.col("_rn") - window)
            .withColumn("n_windows", F.col("_n") - (window + label) + 1)
            .drop("_rn", "_n"))


def cross_site_windows(grid: DataFrame, window: int = 5, label: int = 1, site: str = "site_id",
                       time: str = "measurement_time", value: str = "vehicle_flow_rate") -> DataFrame:
    """W3 across sites: window-major, then time, then site, in long form
    (``window_id``, ``step`` 1.., ``part`` input/label, site, value). Window i
    covers the slots i .. i + window + label - 1 of the dense grid, so each cell
    is copied into the few windows that hold its slot. A grid with too few
    slots for one window is an error.

    The slot index is a running number over the distinct slots, one row each.
    """
    length = window + label
    slots = grid.select(time).distinct()
    index = slots.withColumn("_i", F.row_number().over(Window.orderBy(time)) - 1).withColumn(
        "_n", F.count(F.lit(1)).over(Window.partitionBy()))
    enough = F.when(F.col("_n") >= length, F.col("_n")).otherwise(
        F.raise_error(F.lit("fewer slots than one window needs")))
    starts = F.sequence(F.greatest(F.lit(0), F.col("_i") - (length - 1)), F.least(F.col("_i"), enough - length))
    spread = index.select(time, "_i", F.explode(starts).alias("window_id"))
    step = F.col("_i") - F.col("window_id") + 1
    return grid.select(site, time, value).join(spread, time).select(
        F.col("window_id").cast("long").alias("window_id"), step.cast("long").alias("step"),
        F.when(step <= window, F.lit("input")).otherwise(F.lit("label")).alias("part"), site, time, value)


def train_eval_split(windows: DataFrame, train_fraction: float = 0.8) -> DataFrame:
    """Chronological split per site: the first ``floor(n * p)`` windows
    train, the rest are held out (the reference calls it with p = 0.5)."""
    cut = F.floor(F.col("n_windows") * F.lit(train_fraction))
    return windows.withColumn(
        "split", F.when(F.col("window_id") < cut, F.lit("train")).otherwise(F.lit("eval")))
