"""Property tests on small generated inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitecast.operators import dedup, features, forecast, reshape
from tests.util import readings_df

SETTINGS = dict(max_examples=8, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 6), st.integers(0, 59),
                             st.one_of(st.none(), st.integers(0, 100))), min_size=1, max_size=25)


def _df(spark, rows):
    return readings_df(spark, [(i, s, h, dt.datetime(2024, 1, 1, h, m), v)
                               for i, (s, h, m, v) in enumerate(rows)])


@settings(**SETTINGS)
@given(rows=rows_st, cut=st.integers(0, 25))
def test_upsert_is_idempotent_and_order_independent(spark, rows, cut):
    df = _df(spark, rows)
    a, b = df.limit(cut), df.subtract(df.limit(cut))
    one = dedup.dedup_latest(df)
    two = dedup.dedup_latest(dedup.dedup_latest(b).unionByName(dedup.dedup_latest(a)))
    again = dedup.dedup_latest(one.unionByName(one))
    key = lambda d: sorted(map(tuple, d.select("event_id", "site_id", "measurement_time").collect()))
    assert key(one) == key(two) == key(again)


@settings(**SETTINGS)
@given(rows=rows_st)
def test_imputation_fills_all_and_keeps_present_values(spark, rows):
    d = dedup.dedup_latest(_df(spark, rows))
    g = reshape.impute_site_mean(d)
    assert g.where(F.col("vehicle_flow_rate").isNull()).count() == 0
    present = {(r.site_id, r.measurement_time): float(r.vehicle_flow_rate)
               for r in d.collect() if r.vehicle_flow_rate is not None}
    for r in g.collect():
        if (r.site_id, r.measurement_time) in present:
            assert r.vehicle_flow_rate == present[(r.site_id, r.measurement_time)]
    n_sites = d.select("site_id").distinct().count()
    n_slots = d.select("measurement_time").distinct().count()
    assert g.count() == n_sites * n_slots


@settings(**SETTINGS)
@given(rows=rows_st)
def test_unpivot_of_pivot_is_the_dense_grid(spark, rows):
    d = dedup.dedup_latest(_df(spark, rows))
    long = reshape.unpivot_sites(reshape.pivot_sites(d))
    got = {(r.site_id, r.measurement_time): r.vehicle_flow_rate for r in long.collect()}
    for r in d.collect():
        want = None if r.vehicle_flow_rate is None else float(r.vehicle_flow_rate)
        assert got[(r.site_id, r.measurement_time)] == want


@settings(**SETTINGS)
@given(rows=rows_st, steps=st.integers(1, 4), window=st.integers(1, 4))
def test_forecast_and_window_counts(spark, rows, steps, window):
    d = dedup.dedup_latest(_df(spark, rows))
    per_site = {r.site_id: r["count"] for r in d.groupBy("site_id").count().collect()}
    assert forecast.ma_forecast(d, window, steps).count() == len(per_site) * steps
    w = features.sliding_windows(d, window, 1)
    assert w.count() == sum(max(0, n - (window + 1) + 1) for n in per_site.values())
