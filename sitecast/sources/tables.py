"""Parquet table scans and the fixture views derived from the given tables.

``readings`` maps the ``events`` table onto sensor readings; ``sites`` maps
``customer`` onto the site dimension. Both are plain projections, so filters
and column pruning still reach the Parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.functions.columns import quality_flag

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_to_readings(ev: DataFrame) -> DataFrame:
    """Project raw events onto the reading schema (fixture mapping).

    site = user, slot = hour of the event time, modified time = event time,
    flow = floor(value), k from the props JSON, quality bad for errors.
    """
    k_txt = F.get_json_object("props", "$.k")
    k = k_txt.try_cast("int")
    return ev.select(
        F.col("event_id"),
        F.col("user_id").cast("int").alias("site_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("measurement_time"),
        F.col("ts").alias("modified_time"),
        F.floor("value").cast("int").alias("vehicle_flow_rate"),
        k.alias("k"),
        F.when(F.col("event_type") == "error", F.lit("bad")).otherwise(F.lit("good")).alias("data_quality"),
        k_txt.try_cast("float").alias("average_vehicle_speed"),
        F.concat(F.lit("lane"), (k % 3 + 1).cast("string")).alias("specific_lane"),
        F.concat(F.lit("POINT ("), (F.col("user_id") % 10 + 18).cast("string"), F.lit(" "),
                 (F.col("user_id") % 7 + 59).cast("string"), F.lit(")")).alias("geometry"),
    )


def readings(spark: SparkSession, sf_dir: str,
             start: dt.datetime | None = None,
             end: dt.datetime | None = None) -> DataFrame:
    """Readings view over ``events``.

    ``start``/``end`` bound ``measurement_time`` exclusively. Because the slot
    is derived (hour of ``ts``), Catalyst cannot push that predicate into the
    scan, so an implied, looser predicate on the raw ``ts`` column is added as
    well: it prunes row groups while the exact predicate stays in place.
    """
    ev = table(spark, sf_dir, "events")
    if start is not None:
        ev = ev.where(F.col("ts") >= F.lit(start))
    if end is not None:
        ev = ev.where(F.col("ts") < F.lit(end + dt.timedelta(hours=1)))
    r = events_to_readings(ev)
    if start is not None:
        r = r.where(F.col("measurement_time") > F.lit(start))
    if end is not None:
        r = r.where(F.col("measurement_time") < F.lit(end))
    return r


def with_quality(df: DataFrame) -> DataFrame:
    return df.withColumn("data_quality_categorical", quality_flag())


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site dimension: id -> (lat, lon) as text, derived from ``customer``.

    The coordinates are built from integer arithmetic on the key so both
    engines render the same text.
    """
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.cast("int").alias("site_id"),
        F.concat(F.lit("59."), F.lpad(((key * 7919) % 100000).cast("string"), 5, "0")).alias("lat"),
        F.concat(F.lit("18."), F.lpad(((key * 104729) % 100000).cast("string"), 5, "0")).alias("lon"),
        F.col("c_mktsegment").alias("segment"),
    )
