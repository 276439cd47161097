"""Chart-ready series and the site dimension (W2, A9, A10, J3, P13-P15,
T9, T10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitecast.functions.columns import average_rank, display_name, type_label
from sitecast.operators.joins import lookup_join


def label_types(forecasts: DataFrame) -> DataFrame:
    """``type`` Actual/Prediction and the chart ``display_name``."""
    return forecasts.withColumn("type", type_label()).withColumn("display_name", display_name())


def site_series(forecasts: DataFrame) -> DataFrame:
    """Every site's points split by type and forecaster, in time
    order (``point_index`` 1..), ready to filter on one site."""
    w = Window.partitionBy("site_id", "type", "forecast_type").orderBy("measurement_time")
    return (label_types(forecasts)
            .select("site_id", "measurement_time", "vehicle_flow_rate", "type", "forecast_type",
                    F.row_number().over(w).alias("point_index")))


def select_series(forecasts: DataFrame, site_id=None, type_=None, forecast_type=None) -> DataFrame:
    """The equality filters of a chart (site, Actual/Prediction,
    forecaster), each optional, as plain predicates."""
    df = label_types(forecasts)
    if site_id is not None:
        df = df.where(F.col("site_id") == F.lit(site_id))
    if type_ is not None:
        df = df.where(F.col("type") == F.lit(type_))
    if forecast_type is not None:
        df = df.where(F.col("forecast_type") == F.lit(forecast_type))
    return df.select("measurement_time", "vehicle_flow_rate", "type", "forecast_type").orderBy("measurement_time")


def chart_lists(forecasts: DataFrame) -> DataFrame:
    """One row per (site, type, forecaster) with x/y lists sorted by
    time. Structs are collected so null values keep their place."""
    pts = F.sort_array(F.collect_list(F.struct("measurement_time", "vehicle_flow_rate")))
    return (label_types(forecasts)
            .groupBy("site_id", "type", "forecast_type", "display_name")
            .agg(pts.alias("_pts"))
            .select("site_id", "type", "forecast_type", "display_name",
                    F.transform("_pts", lambda p: p["measurement_time"]).alias("x"),
                    F.transform("_pts", lambda p: p["vehicle_flow_rate"]).alias("y"),
                    F.size("_pts").alias("n_points")))


def forecast_types(forecasts: DataFrame) -> DataFrame:
    """A10: the distinct forecasters that predicted each site."""
    return (label_types(forecasts).where(F.col("type") == "Prediction")
            .select("site_id", "forecast_type").distinct())


def loss_iterations(loss: DataFrame) -> DataFrame:
    """``iteration`` = average rank of the cycle time (ties 1.5, 1.5,
    3), sorted. The window is global, which is fine only because the loss
    table has one row per cycle."""
    return (loss.select(average_rank("measurement_time").alias("iteration"),
                        "train_loss", "eval_loss", "measurement_time")
            .orderBy("iteration"))


def site_points(sites: DataFrame) -> DataFrame:
    """Coordinates text -> double."""
    return sites.select("site_id", F.col("lat").try_cast("double").alias("lat"),
                        F.col("lon").try_cast("double").alias("lon"))


def attach_sites(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Site lookup. The site table grows with the deployment, so it is
    broadcast only after its size is checked."""
    return lookup_join(df, site_points(sites), "site_id", "left")


def map_points(sites: DataFrame, site_id=None) -> DataFrame:
    """The point of a known site; of all sites if the site is unknown or
    none is asked for."""
    points = site_points(sites)
    if site_id is None:
        return points
    known = points.agg(F.coalesce(F.bool_or(F.col("site_id") == F.lit(site_id)), F.lit(False))).scalar()
    return points.where((F.col("site_id") == F.lit(site_id)) | ~known)


def chart_series(forecasts: DataFrame) -> DataFrame:
    """The chart lists with x in microseconds since 1970, as charts take it."""
    return chart_lists(forecasts).withColumn("x", F.transform("x", lambda t: F.unix_micros(t.cast("timestamp"))))


def chart_text(forecasts: DataFrame) -> DataFrame:
    """The chart lists as text, for sinks without arrays."""
    return chart_lists(forecasts).select(
        "site_id", "type", "forecast_type", "display_name",
        F.array_join(F.transform("x", lambda t: F.date_format(t, "yyyy-MM-dd HH:mm:ss")), ",").alias("x"),
        F.array_join(F.transform("y", lambda v: F.coalesce(v.cast("decimal(18,6)").cast("string"), F.lit(""))), ",")
        .alias("y"), "n_points")
