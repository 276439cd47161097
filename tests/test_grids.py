"""Dense grids: their cells are made last, after every shuffle, from rows by site
and day, and equal the plain join of sites, slots and readings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sitecast.operators import features, forecast, reshape
from sitecast.session import scratch_path
from sitecast.streaming import jobs
from tests.util import readings_df, ts


@pytest.fixture(scope="module")
def rows(spark):
    return readings_df(spark, [(i, i % 7, ts(i % 5, day=1 + i % 3), 1, i) for i in range(60)]).dropDuplicates(["site_id", "measurement_time"])


def above_the_cells(df):
    """The plan's nodes that take the cells of the grid."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return lines[:next(i for i, line in enumerate(lines) if "Generate" in line)]


def epochs(rows):
    return rows.select((F.dayofmonth("measurement_time") + 3).alias("epoch"), "site_id", "measurement_time", "vehicle_flow_rate")


@pytest.mark.parametrize("build", [
    lambda r: features.sliding_windows(forecast.model_grid(r), 2, 1),
    lambda r: forecast.ar1_coefficients(forecast.model_grid(r)),
    lambda r: reshape.merge_epochs(epochs(r), 2),
    lambda r: reshape.impute_slot_mean(r),
], ids=["windows", "ar1", "epochs", "slot_mean"])
def test_cells_of_a_grid_are_not_shuffled(spark, rows, build):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not [line for line in above_the_cells(build(rows)) if "Exchange" in line]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_and_null_keys_join_as_before(spark):
    a, b = dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2, 6)
    cells = spark.createDataFrame([(1, a, 4.0), (1, a, 8.0), (1, b, None), (2, b, 1.0), (None, a, 3.0)],
                                  "site_id int, measurement_time timestamp_ntz, vehicle_flow_rate double")
    out = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert out(reshape.impute_site_mean(cells)) == sorted([
        (1, a, 4.0, False), (1, a, 8.0, False), (1, b, 6.0, True), (2, a, 1.0, True), (2, b, 1.0, False),
        (None, a, 3.0, True), (None, b, 3.0, True)], key=str)
    assert out(reshape.impute_slot_mean(cells)) == sorted([
        (1, a, 4.0, False), (1, a, 8.0, False), (1, b, 1.0, True), (2, a, 5.0, True), (2, b, 1.0, False),
        (None, a, 5.0, True), (None, b, 1.0, True)], key=str)


def test_sites_keep_their_own_days(spark, rows):
    got = {(r[0], r[1]): r[2] for r in reshape.impute_site_mean(rows).where("NOT imputed").collect()}
    assert got == {(r.site_id, r.measurement_time): float(r.vehicle_flow_rate) for r in rows.collect()}


def test_snapshot_of_an_epoch_is_not_sorted(spark, rows, monkeypatch):
    """A write by partition columns sorts each task's part of the grid."""
    from pyspark.sql.readwriter import DataFrameWriter
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda *a: pytest.fail("grid written by partition columns"))
    root = scratch_path(spark, "grid-epochs")
    for epoch in (0, 1, 1):
        jobs.write_snapshot(rows, root, epoch)
    got = spark.read.parquet(f"{root}/snapshots")
    assert got.columns == ["site_id", "measurement_time", "vehicle_flow_rate", "imputed", "epoch"]
    n = reshape.impute_slot_mean(rows).count()
    assert sorted(map(tuple, got.groupBy("epoch").count().collect())) == [(0, n), (1, n)]


def test_runs_are_the_grid(spark, rows):
    """Own and empty slots, a site at both ends, sites with nulls only and a null
    site: the runs spread over their slots are the grid, and give its fit."""
    a = lambda d, h: dt.datetime(2024, 1, d, h)
    odd = spark.createDataFrame(
        [(1, a(1, 0), 4.0), (1, a(1, 1), 9.0), (1, a(2, 5), 2.0), (2, a(1, 3), None), (3, a(1, 0), 1.5), (3, a(3, 9), 8.0),
         (4, a(2, 6), 3.0), (None, a(1, 2), 3.0), (None, a(2, 2), 5.0), (5, a(3, 9), None), (5, a(1, 2), 6.0), (6, None, 1.0)],
        "site_id int, measurement_time timestamp_ntz, vehicle_flow_rate double")
    key = lambda r: str(r[:2])
    for d in (rows, odd):
        grid = reshape.impute_site_mean(d)
        runs = reshape.impute_site_mean(d, runs=True)
        slots = [r[0] for r in grid.select("measurement_time").distinct().orderBy("measurement_time").collect()]
        spread = []
        for r in runs.collect():
            end = slots.index(r.measurement_time) + 1
            spread += [(r.site_id, t, r.vehicle_flow_rate, r.imputed) for t in slots[end - r.run:end]]
        assert sorted(spread, key=key) == sorted(map(tuple, grid.collect()), key=key)
        cols = ["site_id", "last_value", "last_time", "n_pairs", F.round("slope", 9), F.round("intercept", 9)]
        fit = forecast.ar1_coefficients(grid).select(*cols).collect()
        got = forecast.ar1_coefficients(runs, run="run").select(*cols).collect()
        assert sorted(map(tuple, got), key=key) == sorted(map(tuple, fit), key=key)


def test_forecast_table_grows_with_the_rows_not_with_the_slots(spark):
    """40 sites of 20 readings on 800 slots: 32,000 cells, at most 41 runs a site."""
    d = readings_df(spark, [(i, i % 40, ts(i), 1, i % 9) for i in range(800)])
    runs = forecast.model_grid(d, runs=True)
    assert runs.agg(F.sum("run")).first()[0] == 32_000 and runs.count() <= 40 * 41
    lines = forecast.forecast_table(d)._jdf.queryExecution().optimizedPlan().toString()
    assert "AS _slots" not in lines                          # the cells themselves are not made


def test_model_step_merges_the_history_once(spark, monkeypatch):
    """Forecasts and loss of a cycle come from one read of the history, and are
    those of the whole history."""
    from sitecast.sources import history, versioned
    hist, out = scratch_path(spark, "h"), scratch_path(spark, "f")
    at = [ts(h, day=1 + day) for day in range(4) for h in range(0, 24, 2)]
    r = readings_df(spark, [(i, s, t, t, (i * 7 + s) % 31) for s in range(5) for i, t in enumerate(at[:len(at) - 9 * (s == 4)])])
    history.upsert(spark, r, hist, 0)
    whole = history.read_history(spark, hist, stats=False)
    plans = []
    monkeypatch.setattr(jobs, "cut_lineage", lambda df: plans.append(df) or df.sparkSession.createDataFrame(df.collect(), df.schema))
    monkeypatch.setattr(versioned, "append_loss", lambda loss, root: plans.append(loss))
    jobs.forecast_step(spark, hist, out)()
    recent, loss = plans
    assert loss.collect() == forecast.newest_loss(whole).collect()
    assert not loss.inputFiles()                             # from the stored rows, not from the history's files
    got = versioned.read_versions(spark, out).drop("version")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, forecast.forecast_table(whole).collect()))
    kept = features.newest_rows(whole, 20, ts(0, day=4))
    assert sorted(map(tuple, recent.collect())) == sorted(map(tuple, kept.select(recent.columns).collect()))
    assert kept.groupBy("site_id").count().orderBy("site_id").collect()[0]["count"] == 12 + 20
