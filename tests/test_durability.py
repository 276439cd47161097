"""No silent loss: crashes and replays of the upsert, compaction, rejects,
damaged files, wide ids, short sites, slots without a label."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from sitecast.functions.columns import strict_int
from sitecast.operators import features, forecast, reshape
from sitecast.session import require_utc
from sitecast.sources import history, ingest, upserts, versioned
from sitecast.streaming import jobs
from tests.util import readings_df, ts


def keys(spark, path):
    return sorted((r.site_id, r.measurement_time, r.vehicle_flow_rate)
                  for r in history.read_history(spark, path).collect())


THREE = [(1, 1, 0, 0, 10), (2, 2, 0, 0, 20), (3, 3, ts(1, day=2), ts(1, 1, day=2), 30)]
TWO = [(4, 4, 0, 0, 40), (5, 5, ts(2, day=2), ts(2, 1, day=2), 50)]


def test_crash_while_a_batch_is_written(spark, tmp_path):
    path = str(tmp_path / "h")
    history.upsert(spark, readings_df(spark, THREE), path, run="s")
    # the second batch died before its commit: task files in the staging folder only
    staging = tmp_path / "h" / "rows" / ".spark-staging-1" / "_temporary" / "0" / "run=s" / "epoch=1"
    readings_df(spark, TWO[:1]).write.parquet(str(staging))
    assert len(keys(spark, path)) == 3
    # and another one halfway through it: one of its two dates is there
    half = readings_df(spark, TWO[:1]).withColumn("measurement_date", F.to_date("measurement_time"))
    upserts.write_batch(half, f"{path}/rows", "s", 1, "measurement_date")
    history.upsert(spark, readings_df(spark, TWO), path, 1, run="s")
    assert len(keys(spark, path)) == 5
    history.upsert(spark, readings_df(spark, TWO), path, 1, run="s")
    assert len(keys(spark, path)) == spark.read.parquet(f"{path}/rows").count() == 5


def test_crash_in_the_first_batch(spark, tmp_path):
    path = str(tmp_path / "h")
    with pytest.raises(FileNotFoundError):
        history.read_history(spark, path)
    history.upsert(spark, readings_df(spark, THREE), path)
    assert len(keys(spark, path)) == 3


def test_calls_without_an_epoch_keep_all_rows(spark, tmp_path):
    path = str(tmp_path / "h")
    history.upsert(spark, readings_df(spark, THREE), path)
    history.upsert(spark, readings_df(spark, TWO), path)
    assert len(keys(spark, path)) == 5


def test_any_sequence_of_epochs_keeps_all_rows(spark, tmp_path):
    path = str(tmp_path / "h")
    for i, epoch in enumerate([0, 1, 2, 0, 1, 7, 7, 3, 0]):     # epochs that start again, repeat, go back
        history.upsert(spark, readings_df(spark, [(i, i, i, i, i)]), path, epoch)
    assert [k[0] for k in keys(spark, path)] == list(range(9))


def test_a_stream_with_a_new_checkpoint_keeps_all_rows(spark, tmp_path):
    path, landing = str(tmp_path / "h"), str(tmp_path / "in")

    def run(rows, checkpoint):
        readings_df(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        schema = spark.read.parquet(landing).schema
        stream = spark.readStream.schema(schema).parquet(landing)
        jobs._run(spark, stream.writeStream.foreachBatch(lambda b, e: history.upsert(spark, b, path, e)), str(tmp_path / checkpoint))
        return [k[0] for k in keys(spark, path)]

    assert run([(1, 1, 0, 0, 1)], "a") == [1]
    assert run([(2, 2, 0, 0, 1)], "a") == [1, 2]          # the same run goes on
    assert run([(3, 3, 0, 0, 1)], "b") == [1, 2, 3]       # epochs from 0 again, in a run of their own
    assert run([(4, 4, 0, 0, 1)], "a") == [1, 2, 3, 4]
    written = spark.read.parquet(f"{path}/rows").select("run", "epoch").distinct().collect()
    assert len({r.run for r in written}) == 2 and len(written) == 4


def test_replays_and_late_rows(spark, tmp_path):
    path = str(tmp_path / "h")
    for _ in range(2):
        history.upsert(spark, readings_df(spark, THREE), path, 0, run="s")
    late = [(9, 1, 0, ts(0, 50), 99), (10, 9, ts(3, day=5), ts(3, 1, day=5), 7)]
    for _ in range(2):
        history.upsert(spark, readings_df(spark, late), path, 1, run="s")
    want = [(1, ts(0), 99), (2, ts(0), 20), (3, ts(1, day=2), 30), (9, ts(3, day=5), 7)]
    assert keys(spark, path) == want and spark.read.parquet(f"{path}/rows").count() == 5
    recent = history.read_history(spark, path, since=dt.date(2024, 1, 2), stats=False)
    assert sorted(r.site_id for r in recent.collect()) == [3, 9]
    assert "PartitionFilters: [isnotnull(measurement_date" in recent._jdf.queryExecution().executedPlan().toString()


def test_rows_written_follow_the_batch(spark, tmp_path):
    path = str(tmp_path / "h")
    history.upsert(spark, readings_df(spark, [(i, i, 0, 0, i) for i in range(500)]), path, 0, run="s")
    history.upsert(spark, readings_df(spark, [(1000, 7, 0, ts(0, 59), 1)]), path, 1, run="s")
    assert spark.read.parquet(f"{path}/rows").where("epoch = 1").count() == 1
    assert history.read_history(spark, path).count() == 500


def test_batches_may_differ_in_columns(spark, tmp_path):
    path = str(tmp_path / "h")
    history.upsert(spark, readings_df(spark, THREE).drop("specific_lane"), path)
    history.upsert(spark, readings_df(spark, TWO), path)
    got = history.read_history(spark, path).select("site_id", "specific_lane").collect()
    assert sorted((r.site_id, r.specific_lane) for r in got) == [(1, None), (2, None), (3, None), (4, "lane1"), (5, "lane1")]


def test_snapshots_of_a_topic_use_the_epoch_of_the_batch(spark, tmp_path):
    root = str(tmp_path / "e")
    for epoch, rows in ((0, THREE), (1, TWO), (1, TWO)):
        jobs.write_snapshot(readings_df(spark, rows), root, epoch)      # no chunk column anywhere
    got = spark.read.parquet(f"{root}/snapshots")
    assert {(r.epoch, r.n) for r in got.groupBy("epoch").agg(F.count("*").alias("n")).collect()} == {(0, 6), (1, 4)}


def test_rejects_are_kept(spark, tmp_path):
    path = str(tmp_path / "h")
    history.upsert(spark, readings_df(spark, THREE + [(7, None, 0, 0, 1), (8, 1, None, None, 2)]), path, 0)
    assert len(keys(spark, path)) == 3
    assert sorted(r.event_id for r in history.read_rejects(spark, path).collect()) == [7, 8]


def test_ids_beyond_32_bits(spark):
    df = spark.createDataFrame([("3000000000",), ("99999999999999999999",), ("1.0",)], "v string")
    got = [(r[0], r[1]) for r in df.select(strict_int("v"), strict_int("v", "long")).collect()]
    assert got == [(None, 3000000000), (None, None), (None, None)]
    raw = spark.createDataFrame([("3000000000", "1", "5", "1", "2024-01-01T00:00:00", "2024-01-01T00:00:00", "l", "g", "good"),
                                 ("x", "1", "5", "1", "2024-01-01T00:00:00", "2024-01-01T00:00:00", "l", "g", "good")],
                                "EventId string, SiteId string, VehicleFlowRate string, AverageVehicleSpeed string, "
                                "MeasurementTime string, ModifiedTime string, SpecificLane string, Geometry string, DataQuality string")
    assert [(r.event_id, r.rejected) for r in ingest.coerce_text(raw).collect()] == [(3000000000, False), (None, True)]


def test_xml_rejects_are_written(spark, tmp_path, monkeypatch):
    damaged = lambda r: original(r).withColumn("SiteId", F.when(F.col("EventId") == "2", "x").otherwise(F.col("SiteId")))
    original = ingest.text_records
    monkeypatch.setattr(ingest, "text_records", damaged)
    rows = readings_df(spark, THREE).withColumn("k", F.lit(1)).withColumn("geometry", F.lit("g"))
    good = ingest.ingest_xml_roundtrip(spark, rows, str(tmp_path / "rejects"))
    assert sorted(r.event_id for r in good.collect()) == [1, 3]
    assert [r.event_id for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == [2]


def forecasts(spark, n):
    return spark.createDataFrame([(i, ts(i % 20), float(i), "ar1") for i in range(n)], versioned.FORECAST_SCHEMA)


def test_damaged_version_files_are_reported(spark, tmp_path, caplog):
    root = str(tmp_path)
    for v in (1, 2):
        versioned.write_version(forecasts(spark, 6).coalesce(1), root, v)
    part = next((tmp_path / f"{versioned.FILE_PREFIX}_2_prediction.parquet").glob("part-*.parquet"))
    part.with_name(f".{part.name}.crc").unlink()
    part.write_bytes(part.read_bytes()[:-7])      # cut off
    with caplog.at_level("WARNING"):
        got = versioned.read_versions(spark, root).collect()
    assert len(got) == 6 and {r.version for r in got} == {1}
    assert "1 damaged" in caplog.text
    assert [r.version for r in versioned.damaged_files(spark, root).collect()] == [2]
    assert versioned.newest_version(versioned.read_versions(spark, root)).first().version == 1


def test_empty_and_large_version_files(spark, tmp_path):
    root = str(tmp_path)
    versioned.write_version(forecasts(spark, 6).coalesce(1), root, 1)
    versioned.write_version(forecasts(spark, 6).limit(0), root, 2)      # an empty table is not damaged
    folder = tmp_path / f"{versioned.FILE_PREFIX}_3_prediction.parquet"
    folder.mkdir()
    (folder / "part-0.parquet").write_bytes(b"PAR1" + b"x" * (versioned.EMPTY_BYTES + 5) + b"PAR1")   # marks alone
    assert [r.version for r in versioned.damaged_files(spark, root).collect()] == [3]
    assert versioned.read_versions(spark, root).count() == 6
    assert versioned.newest_listed(spark, root).first().version == 3
    assert versioned.newest_listed(spark, str(tmp_path / "none")).first().version is None


def test_loss_of_the_newest_day_alone(spark):
    rows = [(i, s, h, h, (h * 7 + s * 3) % 11) for i, (s, h) in enumerate((s, h) for s in range(4) for h in range(0, 100, 1 + s))]
    d = readings_df(spark, rows)
    want = forecast.newest_cycle(forecast.loss_history(d)).collect()
    assert forecast.newest_loss(d).collect() == want and len(want) == 1


def test_no_version_yet(spark, tmp_path):
    got = versioned.read_versions(spark, str(tmp_path / "none"))
    assert got.count() == 0 and "version" in got.columns
    assert versioned.damaged_files(spark, str(tmp_path / "none")).count() == 0
    assert versioned.read_loss(spark, str(tmp_path / "none")).count() == 0


def test_loss_sink_has_one_row_per_cycle(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, 2.0, ts(5, day=d)) for d in (1, 2, 3)], versioned.LOSS_SCHEMA)
    versioned.append_loss(rows, str(tmp_path))
    again = spark.createDataFrame([(9.0, 9.0, ts(7, day=3)), (4.0, 4.0, ts(1, day=4))], versioned.LOSS_SCHEMA)
    versioned.append_loss(again, str(tmp_path))
    got = sorted((r.measurement_time, r.train_loss) for r in versioned.read_loss(spark, str(tmp_path)).collect())
    assert got == [(ts(5, day=1), 1.0), (ts(5, day=2), 1.0), (ts(7, day=3), 9.0), (ts(1, day=4), 4.0)]


def test_short_sites_get_a_forecast(spark):
    r = readings_df(spark, [(i, 1, i, i, i * i) for i in range(12)] + [(50, 2, 0, 0, 8), (51, 2, 1, 1, 9)])
    f = forecast.arp_forecast(r, order=3, steps=2).collect()
    assert {x.site_id for x in f} == {1, 2}
    assert [x.vehicle_flow_rate for x in f if x.site_id == 2] == [9.0, 9.0]
    only_short = forecast.arp_forecast(r.where("site_id = 2"), order=3, steps=2).collect()
    assert [x.vehicle_flow_rate for x in only_short] == [9.0, 9.0]


def test_slots_without_a_label_are_an_error(spark):
    r = readings_df(spark, [(1, 1, 0, 0, 10), (2, 1, 5, 5, 20)])
    with pytest.raises(Exception, match="no pivot label"):
        reshape.pivot_sites(r, reshape.slot_calendar(ts(0), 3)).collect()
    half = readings_df(spark, [(1, 1, ts(0), 0, 10), (2, 1, ts(0) + dt.timedelta(microseconds=5), 0, 20)])
    with pytest.raises(Exception, match="no pivot label"):
        reshape.pivot_sites(half, reshape.slot_calendar(ts(0), 3)).collect()


def test_observed_value_beats_a_newer_fill(spark):
    # epoch 1: site 1 reads slot 0; epoch 2 has slot 0 for site 2 alone
    cells = spark.createDataFrame([(1, 1, ts(0), 10.0), (2, 1, ts(1), 5.0), (2, 2, ts(0), 30.0), (2, 1, ts(0), None),
                                   (4, 2, ts(1), None)], "epoch int, site_id int, measurement_time timestamp_ntz, vehicle_flow_rate double")
    got = {(r.window_id, r.site_id, r.measurement_time): r.vehicle_flow_rate
           for r in reshape.merge_epochs(cells, 4, last_window=F.lit(1)).collect()}
    assert got == {(1, 1, ts(0)): 10.0, (1, 1, ts(1)): 5.0, (1, 2, ts(0)): 30.0, (1, 2, ts(1)): 5.0}


def test_windows_start_at_one(spark):
    cells = spark.createDataFrame([(e, 1, ts(e), float(e)) for e in range(6)],
                                  "epoch int, site_id int, measurement_time timestamp_ntz, vehicle_flow_rate double")
    assert sorted({r.window_id for r in reshape.merge_epochs(cells, 4).collect()}) == [1, 2]
    assert jobs.window_of_epochs(spark, "/nowhere", 3) is None


def test_cross_site_windows(spark):
    grid = spark.createDataFrame([(s, ts(h), float(10 * s + h)) for s in (1, 2) for h in range(4)],
                                 "site_id int, measurement_time timestamp_ntz, vehicle_flow_rate double")
    got = sorted(map(tuple, features.cross_site_windows(grid, 2, 1).select(
        "window_id", "step", "part", "site_id", "vehicle_flow_rate").collect()))
    want = sorted((w, k + 1, "input" if k < 2 else "label", s, float(10 * s + w + k))
                  for w in range(2) for k in range(3) for s in (1, 2))
    assert got == want
    with pytest.raises(Exception, match="fewer slots"):
        features.cross_site_windows(grid, 5, 1).collect()


def test_pull_filter_conjuncts(spark):
    r = readings_df(spark, [(i, i % 3, i, i, i) for i in range(9)]).withColumn("region_id", F.col("site_id") + 10)
    ids = lambda **k: sorted(x.event_id for x in ingest.pull_filter(r, **k).collect())
    assert ids() == list(range(9))
    assert ids(start=ts(1), end=ts(7)) == [2, 3, 4, 5, 6]
    assert ids(start=ts(1), site_id=0) == [3, 6] and ids(region_id=12) == [2, 5, 8]
    assert ids(site_id=0, region_id=12) == []


def test_messages_sink_round_trip(spark, tmp_path):
    rows = readings_df(spark, THREE).withColumn("geometry", F.lit("g")).withColumn("average_vehicle_speed", F.lit(1.0).cast("float"))
    path = str(tmp_path / "topic")
    for _ in range(2):     # a topic is appended to
        ingest.write_messages(ingest.encode_json(rows), "files", path)
    back = ingest.parse_json(spark.read.text(path).select(F.col("value").cast("binary").alias("value")))
    assert sorted(r.event_id for r in back.collect()) == [1, 1, 2, 2, 3, 3]


def test_session_zone_must_be_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_requested_sites_without_readings(spark):
    wanted = spark.createDataFrame([(1,), (99,)], "site_id int")
    assert [r.site_id for r in forecast.missing_sites(wanted, readings_df(spark, THREE)).collect()] == [99]


def test_slot_fill_cost_follows_the_cells(spark):
    """Eight times the slots cost about eight times, not 64."""
    def seconds(slots):
        d = (spark.range(slots * 10).select((F.col("id") % 20).cast("int").alias("site_id"), F.timestamp_add(
            "MINUTE", (F.col("id") / 10).cast("int"), F.lit(ts(0))).alias("measurement_time"),
            F.col("id").cast("int").alias("vehicle_flow_rate")))
        began = time.perf_counter()
        reshape.impute_slot_mean(d).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began
    seconds(1000)
    small, large = min(seconds(4000) for _ in range(3)), seconds(32000)
    assert large < 12 * max(small, 0.4)


def test_output_order_and_columns(spark):
    from sitecast.plans import catalog
    d = "/root/testdata/sf0.001"
    rows = [(r.site_id, r.measurement_time, r.forecast_type) for r in catalog.q_forecast_union(spark, d).collect()]
    assert rows == sorted(rows)
    assert catalog.q_pivot_sites(spark, d).columns == ["site_id", *catalog.CALENDAR]
    ranks = [r.iteration for r in catalog.q_loss_iteration_rank(spark, d).collect()]
    assert ranks == sorted(ranks) and len(set(ranks)) == len(ranks)
