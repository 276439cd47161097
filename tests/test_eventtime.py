"""Event-time streams: equality with DuckDB, late rows accounted for, restarts,
timers, and bounded state."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sitecast.operators import temporal
from sitecast.plans.compare import compare, duck
from sitecast.plans.registry import all_oracle
from sitecast.sources import tables
from sitecast.streaming import eventtime, jobs
from tests.conftest import SMOKE


@pytest.mark.parametrize("name", sorted(set(eventtime.QUERIES) - {"stream_hopping", "stream_late_rows"}))
def test_stream_equals_oracle(spark, name):
    res = compare(E.queries()[name](spark, SMOKE), duck(SMOKE), all_oracle()[name])
    assert res["names"] and res["types"] and res["rows"] == res["oracle_rows"] > 0 and res["hash"], res


def test_hopping_windows_and_late_rows_are_all_rows(spark, tmp_path):
    landing = jobs.land_events(spark, SMOKE, n_files=4, delayed=eventtime.DELAYED)
    windows, late = eventtime.run_hopping(spark, landing, str(tmp_path / "hop"))
    con = duck(SMOKE)
    pairs = (tables.readings(spark, SMOKE).withColumn("event_time", F.col("modified_time").cast("timestamp"))
             .select("site_id", eventtime._hops(eventtime.WINDOW_HOURS, eventtime.SLIDE_HOURS).alias("w"))
             .groupBy("site_id", eventtime._ntz("w.start").alias("window_start"), eventtime._ntz("w.end").alias("window_end"))
             .agg(F.count(F.lit(1)).alias("n")))
    newest = con.sql("SELECT max(ts) FROM events").fetchall()[0][0] - dt.timedelta(hours=eventtime.DELAY_HOURS)
    both = windows.select("site_id", "window_start", F.col("n_readings").alias("n")).unionByName(
        late.groupBy("site_id", "window_start").agg(F.count(F.lit(1)).alias("n")))
    got = {tuple(r) for r in both.groupBy("site_id", "window_start").agg(F.sum("n")).collect()}
    want = {(r.site_id, r.window_start, r.n) for r in pairs.where(F.col("window_end") <= F.lit(newest)).collect()}
    assert want <= got and late.count() > 0
    assert windows.count() == windows.select("site_id", "window_start").distinct().count()   # emitted once
    # nothing new: nothing changes
    before = (windows.count(), late.count())
    again, late_again = eventtime.run_hopping(spark, landing, str(tmp_path / "hop"))
    assert (again.count(), late_again.count()) == before


def test_late_rows_are_the_same_on_replay(spark, tmp_path):
    root = str(tmp_path / "late")
    events = tables.table(spark, SMOKE, "events")
    old, new = events.where("ts < timestamp_ntz'2024-01-05'"), events.where("ts >= timestamp_ntz'2024-01-20'")
    for epoch, batch in ((0, new), (1, old), (1, old)):
        eventtime.store_late(batch, epoch, root)
    got = spark.read.parquet(f"{root}/late")
    assert got.count() == 2 * old.count() and {r.epoch for r in got.select("epoch").distinct().collect()} == {1}
    eventtime.store_late(events.limit(0), 2, root)      # an empty batch has no mark
    eventtime.store_late(old, 3, root)
    assert spark.read.parquet(f"{root}/late").count() == 4 * old.count()


def test_session_stream_equals_batch_sessions(spark):
    got = E.queries()["stream_sessions"](spark, SMOKE)
    batch = temporal.sessions(tables.readings(spark, SMOKE), ["site_id"], "modified_time", eventtime.GAP_HOURS * temporal.HOUR, {
        "n_readings": ("count", "event_id"), "sum_flow": ("sum", "vehicle_flow_rate"), "max_flow": ("max", "vehicle_flow_rate")})
    closed = {tuple(r) for r in got.collect()}
    assert closed <= {tuple(r) for r in batch.collect()} and len(closed) > 0.8 * batch.count()


SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def at(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def arrive(spark, folder, rows):
    df = spark.createDataFrame([(i, at(h), s, "ok", 1.0, '{"k": 1}') for i, (s, h) in enumerate(rows)], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(folder)


def test_silent_sites_by_timer_over_restarts(spark, tmp_path):
    folder, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))

    def run(rows):
        arrive(spark, folder, rows)
        stream = spark.readStream.schema(SCHEMA).parquet(folder)
        alarms = eventtime.silent_site_stream(stream, silent_hours=10, delay_hours=1)
        # every run is a new query that goes on from the checkpoint
        jobs._run(spark, alarms.writeStream.format("parquet").option("path", out).outputMode("append"), ckpt,
                  state_partitions=2)
        return sorted((r.site_id, (r.silent_from - at(0)) / dt.timedelta(hours=1)) for r in spark.read.parquet(out).collect())

    assert run([(1, 0), (1, 3), (2, 2), (3, 0), (3, 0), (None, 1)]) == []
    assert run([(2, 11), (2, 12), (4, 12)]) == [(3, 0)]                       # site 3 by its timer; 1 until 13
    assert run([(1, 14.5), (2, 14.6)]) == [(1, 3), (3, 0)]                     # reported with its next reading
    assert run([(2, 30)]) == [(1, 3), (1, 14.5), (2, 14.6), (3, 0), (4, 12)]   # each silence once
    assert run([(3, 31), (1, 31), (2, 45)]) == [(1, 3), (1, 14.5), (1, 31), (2, 14.6), (2, 30), (3, 0), (3, 31), (4, 12)]


def test_forecasts_without_actuals_come_out_unmatched(spark, tmp_path):
    folder, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    for rows in ([(1, 0), (1, 1), (2, 0)], [(1, 20), (2, 20)], [(1, 60), (2, 60)]):
        arrive(spark, folder, rows)
        read = lambda: spark.readStream.schema(SCHEMA).parquet(folder)
        joined = eventtime.forecast_join(eventtime.persistence_forecasts(read(), 1), eventtime.arriving_actuals(read(), 1))
        q = jobs._run(spark, joined.writeStream.format("parquet").option("path", out).outputMode("append"), ckpt, state_partitions=2)
    got = sorted((r.site_id, (r.made_at - at(0)) / dt.timedelta(hours=1), r.actual_id is not None)
                 for r in spark.read.parquet(out).collect())
    assert [g for g in got if g[1] < 20] == [(1, 0, True), (1, 1, False), (2, 0, False)]
    # rows that can find no partner any more have left the state
    kept = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    assert kept[-1] <= 4
