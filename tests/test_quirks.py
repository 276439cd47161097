"""One test per observable edge case of the reference (hand-made rows)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sitecast.functions.columns import (average_rank, parse_time_strict, quality_flag,
                                        type_label, display_name, version_from_name)
from sitecast.operators import dedup, features, forecast, reshape, stats
from sitecast.sources import history, ingest
from tests.util import readings_df, ts


def test_json_permissive_parse_and_rejects(spark):
    msgs = spark.createDataFrame(
        [("not json",), (None,),
         ('{"site_id": 60.0, "measurement_time": "2024-01-01T12:00:00"}',),
         ('{"site_id": "60", "measurement_time": "2024-01-01T12:00:00"}',),
         ('{"site_id": 99999999999, "measurement_time": "2024-01-01T12:00:00"}',),
         ('{"site_id": 7, "vehicle_flow_rate": 5, "measurement_time": "2024-01-01T12:00:00+01:00"}',)],
        "value string").select(F.col("value").cast("binary").alias("value"))
    parsed = ingest.parse_json(msgs)
    good, bad = ingest.valid_messages(parsed)
    rows = good.collect()
    assert len(rows) == 1 and rows[0].site_id == 7
    # offset honoured: 12:00+01:00 is 11:00 UTC
    assert rows[0].measurement_time == dt.datetime(2024, 1, 1, 11, 0)
    assert bad.count() == 5


def test_strict_text_coercion(spark):
    raw = spark.createDataFrame(
        [("1", "7", "60.0", "55.5", "2024-01-01T12:00:00", "2024-01-01T12:00:01", "l", "g", "good"),
         ("2", "x", "60", "abc", "2024-01-01T12:00:00", "2024-01-01T12:00:01", "l", "g", "good"),
         ("3", "8", "61", "50", "2024-01-01T12:00:00+01:00", "2024-01-01T12:00:01", "l", "g", "good")],
        "EventId string, SiteId string, VehicleFlowRate string, AverageVehicleSpeed string, "
        "MeasurementTime string, ModifiedTime string, SpecificLane string, Geometry string, DataQuality string")
    out = {r.event_id: r for r in ingest.coerce_text(raw).collect()}
    assert out[1].vehicle_flow_rate is None and out[1].rejected   # 60.0 into an int
    assert out[2].site_id is None and out[2].rejected
    assert out[3].measurement_time == dt.datetime(2024, 1, 1, 11, 0) and not out[3].rejected


def test_fractional_seconds_rejected_by_strict_parse(spark):
    df = spark.createDataFrame([("2024-01-01 12:00:00",), ("2024-01-01 12:00:00.5",)], "t string")
    got = [r[0] for r in df.select(parse_time_strict("t")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 12), None]


def test_quality_flag_is_case_sensitive_and_null_is_zero(spark):
    df = spark.createDataFrame([("good",), ("Good",), (None,), ("bad",)], "data_quality string")
    assert [r[0] for r in df.select(quality_flag()).collect()] == [1, 0, 0, 0]


def test_single_reading_slot_has_null_std(spark):
    r = readings_df(spark, [(1, 1, 0, 0, 10), (2, 2, 1, 1, 10), (3, 3, 1, 1, 20)])
    s = {x.measurement_time.hour: x for x in stats.slot_aggregates(r).collect()}
    assert s[0].std_vehicle_flow_rate is None and s[0].avg_vehicle_flow_rate == 10.0
    assert s[1].std_vehicle_flow_rate == pytest.approx(7.071068)


def test_null_measurement_time_gets_no_slot_stats(spark):
    r = readings_df(spark, [(1, 1, None, None, 10), (2, 1, None, None, 30), (3, 2, 1, 1, 5)])
    out = stats.slot_stats(r).collect()
    assert all(x.avg_vehicle_flow_rate is None for x in out if x.measurement_time is None)


def test_newest_modified_time_wins(spark):
    r = readings_df(spark, [(1, 1, 0, ts(0, 10), 10), (2, 1, 0, ts(0, 50), 20), (3, 1, 0, ts(0, 30), 30)])
    assert [x.vehicle_flow_rate for x in dedup.dedup_latest(r).collect()] == [20]


def test_lane_in_key_keeps_both_lanes(spark):
    r = readings_df(spark, [(1, 1, 0, 0, 10, "good", "lane1"), (2, 1, 0, 0, 20, "good", "lane2")])
    assert dedup.dedup_latest(r).count() == 1
    assert dedup.dedup_latest(r, ("site_id", "measurement_time", "specific_lane")).count() == 2


def test_moving_average_divides_by_window_when_rows_missing(spark):
    r = readings_df(spark, [(1, 1, 0, 0, 10), (2, 1, 1, 1, 20)])
    f = forecast.ma_forecast(r, window=5, steps=2).orderBy("measurement_time").collect()
    assert f[0].vehicle_flow_rate == pytest.approx(6.0)             # (0+0+0+10+20)/5
    assert f[1].vehicle_flow_rate == pytest.approx((10 + 20 + 6) / 5)
    assert f[0].measurement_time == ts(1, 1)                        # newest slot + 1 minute
    avail = forecast.ma_forecast(r, window=5, steps=1, divisor="available").collect()
    assert avail[0].vehicle_flow_rate == pytest.approx(15.0)


def test_null_flow_in_window_gives_null_forecast(spark):
    r = readings_df(spark, [(1, 1, 0, 0, 10), (2, 1, 1, 1, None), (3, 1, 2, 2, 30)])
    f = forecast.ma_forecast(r, window=3, steps=1).collect()
    assert f[0].vehicle_flow_rate is None


def test_constant_series_repeats_last_value(spark):
    r = readings_df(spark, [(i, 1, i, i, 7) for i in range(6)])
    f = forecast.ar1_forecast(r, steps=3).collect()
    assert [x.vehicle_flow_rate for x in f] == [7.0, 7.0, 7.0]


def test_ar1_recursion(spark):
    vals = [1, 3, 7, 15, 31]          # v_t = 1 + 2 v_{t-1}
    r = readings_df(spark, [(i, 1, i, i, v) for i, v in enumerate(vals)])
    f = forecast.ar1_forecast(r, steps=2).orderBy("measurement_time").collect()
    assert [x.vehicle_flow_rate for x in f] == [pytest.approx(63.0), pytest.approx(127.0)]


def test_slot_mean_fill_and_zero_for_all_missing(spark):
    # slot 0: sites 1,2 present; slot 1: only site 1; slot 2: present but null
    r = readings_df(spark, [(1, 1, 0, 0, 10), (2, 2, 0, 0, 30), (3, 1, 1, 1, 4),
                            (4, 1, 2, 2, None)])
    g = {(x.site_id, x.measurement_time.hour): x.vehicle_flow_rate
         for x in reshape.impute_slot_mean(r).collect()}
    assert g[(2, 1)] == 4.0           # slot mean across sites
    assert g[(2, 2)] == 0.0 and g[(1, 2)] == 0.0   # whole slot null -> 0
    assert g[(1, 0)] == 10.0          # present value unchanged
    assert reshape.impute_slot_mean(r, truncate_int=True).count() == 6


def test_site_mean_fill_and_all_null_site(spark):
    r = readings_df(spark, [(1, 1, 0, 0, 10), (2, 1, 1, 1, 20), (3, 2, 0, 0, None)])
    g = {(x.site_id, x.measurement_time.hour): x.vehicle_flow_rate
         for x in reshape.impute_site_mean(r).collect()}
    assert g[(2, 1)] == 0.0 and g[(2, 0)] == 0.0   # site mean undefined -> 0
    assert g[(1, 0)] == 10.0


def test_strict_pivot_rejects_duplicates(spark):
    r = readings_df(spark, [(1, 1, 0, 0, 10), (2, 1, 0, 0, 20)])
    with pytest.raises(Exception) as e:
        reshape.pivot_strict(r).collect()
    assert "duplicate" in str(e.value)
    ok = readings_df(spark, [(1, 1, 0, 0, 10), (2, 2, 1, 1, 20)])
    wide = reshape.pivot_strict(ok)
    assert wide.columns == ["site_id", "2024-01-01 00:00:00", "2024-01-01 01:00:00"]


def test_average_rank_ties(spark):
    df = spark.createDataFrame([(ts(1),), (ts(1),), (ts(2),), (None,)], "t timestamp_ntz")
    got = sorted((r[0] is None, r[0]) for r in df.select(average_rank("t")).collect())
    assert [x[1] for x in got] == [1.5, 1.5, 3.0, None]


def test_version_from_file_name(spark):
    df = spark.createDataFrame(
        [("/x/traffic_data_to_model_12_prediction.parquet/part-0.parquet",),
         ("/x/traffic_data_to_model_abc_prediction.parquet",), ("/x/other.parquet",)], "p string")
    assert [r[0] for r in df.select(version_from_name("p")).collect()] == [12, -1, -1]


def test_labels(spark):
    df = spark.createDataFrame([("actual",), ("gru",), ("moving_avg",), ("ar1",), (None,)], "forecast_type string")
    rows = df.select(type_label(), display_name()).collect()
    assert [r[0] for r in rows] == ["Actual", "Prediction", "Prediction", "Prediction", "Prediction"]
    assert [r[1] for r in rows] == ["actual", "GRU", "Moving Avg", "ar1", None]


def test_requested_site_without_readings_is_rejected(spark):
    r = readings_df(spark, [(i, 1, i, i, 5) for i in range(25)])
    wanted = spark.createDataFrame([(1,), (99,)], "site_id int")
    fc = forecast.forecast_table(r.join(wanted, "site_id", "left_semi"))
    assert {x.site_id for x in fc.collect()} == {1}
    missing = wanted.join(r.select("site_id").distinct(), "site_id", "left_anti")
    assert [x.site_id for x in missing.collect()] == [99]


def test_warm_up_gate(spark):
    r = readings_df(spark, [(i, 1, i, i, 5) for i in range(19)] + [(100 + i, 2, i, i, 5) for i in range(20)])
    assert [x.site_id for x in features.eligible_sites(r, 20).collect()] == [2]
    assert {x.site_id for x in forecast.forecast_table(r).collect()} == {2}


def test_window_count(spark):
    r = readings_df(spark, [(i, 1, i, i, i) for i in range(8)] + [(50, 2, 0, 0, 1)])
    w = features.sliding_windows(r, 5, 1)
    assert w.count() == 8 - 6 + 1
    assert w.where("window_id = 0").first().w1 == 0.0


def test_upsert_replay_late_rows_and_bootstrap(spark, tmp_path):
    path = str(tmp_path / "history")
    b1 = readings_df(spark, [(1, 1, 0, ts(0, 10), 10), (2, 2, 0, ts(0, 20), 20)])
    history.upsert(spark, b1, path, epoch_id=0)            # bootstrap: path absent
    def snapshot():
        return sorted(sorted(r.asDict().items()) for r in history.read_history(spark, path).collect())
    first = snapshot()
    history.upsert(spark, b1, path, epoch_id=0)            # replay: no change
    assert snapshot() == first
    late = readings_df(spark, [(3, 1, 0, ts(0, 40), 11), (4, 3, ts(5, day=2), ts(5, 1, day=2), 7)])
    history.upsert(spark, late, path, epoch_id=1)          # late + newer row merged
    h = {(x.site_id, x.measurement_time): x for x in history.read_history(spark, path).collect()}
    assert h[(1, ts(0))].vehicle_flow_rate == 11 and len(h) == 3
    assert h[(1, ts(0))].avg_vehicle_flow_rate == pytest.approx(15.5)   # stats after merge


def test_unreadable_history_is_an_error(spark, tmp_path):
    path = tmp_path / "history"
    b = readings_df(spark, [(1, 1, 0, 0, 10)])
    history.upsert(spark, b, str(path), epoch_id=0)
    part = next((path / "rows").rglob("part-*.parquet"))
    for f in (path / "rows").rglob(".*.crc"):
        f.unlink()
    part.write_bytes(b"not parquet")
    with pytest.raises(Exception):
        history.read_history(spark, str(path)).collect()
    assert part.read_bytes() == b"not parquet"


def test_series_filters(spark):
    from sitecast.operators import series
    f = spark.createDataFrame(
        [(1, ts(0), 1.0, "actual"), (1, ts(1), 2.0, "moving_avg"), (2, ts(0), 3.0, "actual")],
        "site_id int, measurement_time timestamp_ntz, vehicle_flow_rate double, forecast_type string")
    got = series.select_series(f, site_id=1, type_="Prediction").collect()
    assert [(r.vehicle_flow_rate, r.forecast_type) for r in got] == [(2.0, "moving_avg")]
