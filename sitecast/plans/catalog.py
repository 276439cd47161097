"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over
the given tables. Streaming and write-backed queries live in
``sitecast.streaming.jobs`` and ``sitecast.sources.history`` and are added
to the registry at the bottom."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.functions.columns import format_time, parse_time_strict
from sitecast.operators import dedup, features, forecast, reshape, series, stats
from sitecast.operators.joins import lookup_join
from sitecast.session import cut_lineage, scratch_path
from sitecast.sources import ingest, tables, versioned

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the reference's model loop.
HISTORY = 20        # readings per site fed to the model
WINDOW = 5          # moving-average window and input sequence length
STEPS = 5           # forecast horizon (1-minute steps)
SPLIT = 0.5         # train fraction used at the call site
N_SAMPLES = 1000    # pull row cap (function default)
N_VERSIONS = 3      # forecast versions materialised for last-wins reads
N_EPOCHS = 4        # epoch merge width (the reference merges 4 snapshots)
RANGE_START = dt.datetime(2024, 1, 10)
RANGE_END = dt.datetime(2024, 1, 20)
SITE_SEGMENT = "BUILDING"
PULL_SITE, PULL_REGION = 7, 3   # conjuncts of the bounded pull
CALENDAR = reshape.slot_calendar(dt.datetime(2024, 1, 1), 30 * 24)   # pivot labels: the hours of the event month


def _d(spark, sf_dir) -> DataFrame:
    return dedup.dedup_latest(tables.readings(spark, sf_dir))


def _forecasts(spark, sf_dir) -> DataFrame:
    return forecast.forecast_table(_d(spark, sf_dir), window=WINDOW, steps=STEPS,
                                   history=HISTORY, actual_k=STEPS, min_history=HISTORY)


def _long(c):
    return F.col(c).cast("long").alias(c)


# -- 1: minimum slice -------------------------------------------------------

def q_dedup_latest(spark, sf_dir):
    return _d(spark, sf_dir)


def q_latest_n_per_site(spark, sf_dir):
    return (features.latest_n_per_site(_d(spark, sf_dir), HISTORY)
            .select("site_id", "measurement_time", "vehicle_flow_rate", _long("rn")))


def q_ma_forecast(spark, sf_dir):
    return forecast.ma_forecast(_d(spark, sf_dir), WINDOW, STEPS)


# -- 2: statistics, flags, filters ------------------------------------------

def q_slot_stats(spark, sf_dir):
    return stats.slot_stats(tables.readings(spark, sf_dir))


def q_quality_flag(spark, sf_dir):
    return tables.with_quality(tables.readings(spark, sf_dir)).select(
        "event_id", "data_quality", "data_quality_categorical")


def q_latest_slot(spark, sf_dir):
    return stats.latest_slot(_d(spark, sf_dir))


def q_site_filter(spark, sf_dir):
    wanted = tables.sites(spark, sf_dir).where(F.col("segment") == SITE_SEGMENT).select("site_id")
    return lookup_join(_d(spark, sf_dir), wanted, "site_id", "left_semi")


def q_time_range_filter(spark, sf_dir):
    return tables.readings(spark, sf_dir, RANGE_START, RANGE_END)


def q_pull_filter(spark, sf_dir):
    """S2 with all conjuncts: time range, site and region of the site."""
    region = F.pmod(F.col("site_id"), F.lit(4)) + 1
    near = ingest.pull_filter(tables.readings(spark, sf_dir).withColumn("region_id", region),
                              RANGE_START, RANGE_END, region_id=PULL_REGION)
    one = ingest.pull_filter(tables.readings(spark, sf_dir).withColumn("region_id", region),
                             RANGE_START, RANGE_END, site_id=PULL_SITE)
    return near.unionByName(one)


def q_bounded_limit(spark, sf_dir):
    return ingest.bounded_pull(tables.readings(spark, sf_dir), N_SAMPLES)


def q_batch_metrics(spark, sf_dir):
    r = tables.readings(spark, sf_dir)
    r = r.withColumn("pull_date", F.to_date("measurement_time"))
    return stats.batch_metrics(r, "pull_date")


# -- 3: reshape and imputation ----------------------------------------------

def q_impute_site_mean(spark, sf_dir):
    return reshape.impute_site_mean(features.latest_n_per_site(_d(spark, sf_dir), HISTORY))


def q_impute_slot_mean(spark, sf_dir):
    return reshape.impute_slot_mean(_d(spark, sf_dir))


def q_gap_census(spark, sf_dir):
    return reshape.gap_census(reshape.impute_site_mean(
        features.latest_n_per_site(_d(spark, sf_dir), HISTORY)))


def q_pivot_sites(spark, sf_dir):
    return reshape.pivot_sites(_d(spark, sf_dir), CALENDAR)


def q_pivot_strict(spark, sf_dir):
    latest = features.latest_n_per_site(_d(spark, sf_dir), HISTORY).drop("rn")
    return reshape.pivot_strict(latest, CALENDAR)


def q_unpivot_sites(spark, sf_dir):
    return reshape.unpivot_sites(reshape.pivot_sites(_d(spark, sf_dir), CALENDAR))


def q_recent_actuals(spark, sf_dir):
    return forecast.recent_actuals(_d(spark, sf_dir), HISTORY, STEPS)


def q_epoch_merge(spark, sf_dir):
    r = tables.readings(spark, sf_dir)
    first_day = r.agg(F.min(F.to_date("modified_time"))).scalar()
    r = r.withColumn("epoch", F.datediff(F.to_date("modified_time"), first_day))
    # each day re-delivers its last readings with the next one, as the pulls do,
    # and a correction may come a day late: epochs overlap in their slots
    late = r.where(F.col("event_id") % 5 == 0).withColumn("epoch", F.col("epoch") + 1).withColumn(
        "vehicle_flow_rate", F.when(F.col("event_id") % 2 == 0, F.col("vehicle_flow_rate") + 1))
    both = r.unionByName(late).where(F.col("measurement_time").isNotNull())
    d_e = dedup.keep_latest(both, ("epoch", "site_id", "measurement_time"), ("modified_time", "event_id"))
    last_epoch = r.where(F.col("measurement_time").isNotNull()).agg(F.max("epoch")).scalar()
    return reshape.merge_epochs(d_e, n_epochs=N_EPOCHS, last_window=last_epoch - (N_EPOCHS - 1))


# -- 4: windows, split, AR, holdout error -----------------------------------

def q_eligible_sites(spark, sf_dir):
    return features.eligible_sites(_d(spark, sf_dir), HISTORY)


def _grid(spark, sf_dir) -> DataFrame:
    """The model's input (W1 -> T2): the default of the windows and fits."""
    return forecast.model_grid(_d(spark, sf_dir), HISTORY)


def _windows(d: DataFrame) -> DataFrame:
    w = features.sliding_windows(d, WINDOW, 1)
    return w.withColumn("window_id", F.col("window_id").cast("long"))


def _split(d: DataFrame) -> DataFrame:
    w = features.train_eval_split(features.sliding_windows(d, WINDOW, 1), SPLIT)
    return w.select("site_id", "measurement_time", _long("window_id"), "n_windows", "split")


def q_sliding_windows(spark, sf_dir):
    return _windows(_grid(spark, sf_dir))


def q_sliding_windows_raw(spark, sf_dir):
    return _windows(_d(spark, sf_dir))


def q_cross_site_windows(spark, sf_dir):
    return features.cross_site_windows(_grid(spark, sf_dir), WINDOW, 1)


def q_train_eval_split(spark, sf_dir):
    return _split(_grid(spark, sf_dir))


def q_train_eval_split_raw(spark, sf_dir):
    return _split(_d(spark, sf_dir))


def q_ar1_forecast(spark, sf_dir):
    return forecast.ar1_forecast(_grid(spark, sf_dir), STEPS)


def q_ar1_forecast_raw(spark, sf_dir):
    return forecast.ar1_forecast(_d(spark, sf_dir), STEPS)


def q_arp_forecast(spark, sf_dir):
    return forecast.arp_forecast(_grid(spark, sf_dir), WINDOW, STEPS)


def q_backtest_mse(spark, sf_dir):
    return forecast.backtest_mse(_grid(spark, sf_dir), WINDOW, SPLIT)


def q_backtest_mse_raw(spark, sf_dir):
    return forecast.backtest_mse(_d(spark, sf_dir), WINDOW, SPLIT)


def q_forecast_horizon(spark, sf_dir):
    return forecast.forecast_horizon(_d(spark, sf_dir), STEPS)


# -- 5: forecast table, versions, series ------------------------------------

def q_forecast_union(spark, sf_dir):
    return forecast.sorted_forecasts(_forecasts(spark, sf_dir))


def q_label_type(spark, sf_dir):
    return series.label_types(_forecasts(spark, sf_dir))


def q_forecast_types(spark, sf_dir):
    return series.forecast_types(_forecasts(spark, sf_dir))


def q_site_series(spark, sf_dir):
    return series.site_series(_forecasts(spark, sf_dir)).withColumn(
        "point_index", F.col("point_index").cast("long"))


def q_chart_series(spark, sf_dir):
    return series.chart_series(_forecasts(spark, sf_dir))


def q_chart_text(spark, sf_dir):
    return series.chart_text(_forecasts(spark, sf_dir))


def q_single_file_export(spark, sf_dir):
    """One site's forecasts, sorted and exported as one file; read back
    with each row's position in it."""
    path = scratch_path(spark, "export")
    one = _forecasts(spark, sf_dir).where(F.col("site_id") == PULL_SITE)
    versioned.export_single_file(forecast.sorted_forecasts(one), path)
    rows = spark.read.parquet(path)
    files = rows.agg(F.count_distinct("_metadata.file_path")).scalar()
    return rows.select("*", F.col("_metadata.row_index").alias("position"), files.alias("n_files"))


def q_forecast_methods(spark, sf_dir):
    """One forecaster, the other, both, or none (recent actuals alone)."""
    d = _d(spark, sf_dir)
    parts = [forecast.forecast_table(d, methods, WINDOW, STEPS, HISTORY, STEPS, HISTORY)
             .withColumn("choice", F.lit("+".join(methods) or "none"))
             for methods in (("moving_avg",), ("ar1",), ("ar1", "moving_avg"), ())]
    return dedup.union_all(parts)


def q_missing_sites(spark, sf_dir):
    """Q13: requested sites that have no reading."""
    return forecast.missing_sites(tables.sites(spark, sf_dir), tables.readings(spark, sf_dir))


def q_map_points(spark, sf_dir):
    """The chosen site's point; all points for an unknown or no site."""
    sites = tables.sites(spark, sf_dir)
    parts = [series.map_points(sites, s).withColumn("chosen", F.lit(name))
             for s, name in ((PULL_SITE, "known"), (-1, "unknown"), (None, "none"))]
    return dedup.union_all(parts)


def q_site_dim_join(spark, sf_dir):
    return series.attach_sites(_forecasts(spark, sf_dir), tables.sites(spark, sf_dir))


def q_parse_forecast_time(spark, sf_dir):
    f = _forecasts(spark, sf_dir).withColumn("time_text", format_time("measurement_time"))
    return f.select("site_id", "forecast_type", "time_text",
                    parse_time_strict("time_text").alias("parsed_time"), "vehicle_flow_rate")


def versions_in_memory(spark, sf_dir, n_versions: int = N_VERSIONS) -> DataFrame:
    """The forecast table as it stood after each of the last ``n`` hourly
    cut-offs (version 1 = oldest); a reading counts for a version only if its
    slot is at or before that cut-off."""
    r = tables.readings(spark, sf_dir)
    newest = r.agg(F.max("measurement_time")).scalar()
    # Dedup is keyed by slot, so deduplicating once and filtering each
    # version by its cut-off equals deduplicating each version's input. The
    # checkpoint keeps Catalyst from pushing the cut-offs below the dedup
    # (which would run it once per version).
    d = cut_lineage(dedup.dedup_latest(r.select(
        "event_id", "site_id", "measurement_time", "modified_time", "vehicle_flow_rate")))
    parts = []
    for v in range(1, n_versions + 1):
        cutoff = F.timestamp_add("HOUR", F.lit(v - n_versions), newest)
        dv = d.where(F.col("measurement_time") <= cutoff)
        fv = forecast.forecast_table(dv, window=WINDOW, steps=STEPS, history=HISTORY,
                                     actual_k=STEPS, min_history=HISTORY)
        parts.append(fv.withColumn("version", F.lit(v)))
    return dedup.union_all(parts)


def q_forecast_dedup_last(spark, sf_dir):
    return dedup.keep_last_version(versions_in_memory(spark, sf_dir))


def q_loss_history(spark, sf_dir):
    return forecast.loss_history(_d(spark, sf_dir), WINDOW, SPLIT)


def q_loss_iteration_rank(spark, sf_dir):
    """W2 over the loss sink: the cycles are written, the newest once more, and
    read back."""
    root = scratch_path(spark, "losses")
    loss = cut_lineage(forecast.loss_history(_d(spark, sf_dir), WINDOW, SPLIT))
    versioned.append_loss(loss, root)
    versioned.append_loss(forecast.newest_cycle(loss), root)
    return series.loss_iterations(versioned.read_loss(spark, root))


# -- 6: ingest --------------------------------------------------------------

def _damaged_text(spark, sf_dir) -> DataFrame:
    """Text records of which some fields do not parse, and with ids beyond 32
    bits, so that the strict types and the rejects have work."""
    n = F.col("EventId").cast("long")
    return (ingest.text_records(tables.readings(spark, sf_dir))
            .withColumn("VehicleFlowRate", F.when(n % 11 == 0, F.concat("VehicleFlowRate", F.lit(".0")))
                        .otherwise(F.col("VehicleFlowRate")))
            .withColumn("SiteId", F.when(n % 13 == 0, F.lit("x1")).otherwise(F.col("SiteId")))
            .withColumn("MeasurementTime", F.when(n % 17 == 0, F.lit("yesterday")).otherwise(F.col("MeasurementTime")))
            .withColumn("EventId", F.when(n % 19 == 0, F.lit("1e3"))
                        .otherwise((n + F.lit(3_000_000_000)).cast("string"))))


def q_coerce_types(spark, sf_dir):
    return ingest.coerce_text(_damaged_text(spark, sf_dir))


def q_rename_project(spark, sf_dir):
    return ingest.rename_project(ingest.source_records(tables.readings(spark, sf_dir)))


def q_encode_json(spark, sf_dir):
    msgs = ingest.encode_json(tables.readings(spark, sf_dir))
    return ingest.json_fields_as_text(msgs)


def q_parse_json(spark, sf_dir):
    msgs = ingest.encode_json(tables.readings(spark, sf_dir))
    return ingest.parse_json(msgs)


def q_ingest_xml(spark, sf_dir):
    return ingest.ingest_xml_roundtrip(spark, tables.readings(spark, sf_dir))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
