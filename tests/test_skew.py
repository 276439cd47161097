"""One site holding a third of all rows: results stay exact and the plans
still reduce the hot key before shuffling."""

import pytest
from pyspark.sql import functions as F

from sitecast.operators import dedup, features, forecast, stats
from sitecast.plans import oracle as O
from sitecast.plans.compare import compare, duck
from sitecast.sources import tables
from tests.conftest import SMALL

HOT = 7


def skewed_readings(spark):
    ev = tables.table(spark, SMALL, "events")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(HOT).cast("long"))
                       .otherwise(F.col("user_id")))
    return tables.events_to_readings(ev)


SKEWED = O.READINGS.replace(
    "FROM events)", f"FROM (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN {HOT} ELSE user_id END AS user_id) FROM events))")


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_hot_site_holds_a_third(spark):
    r = skewed_readings(spark)
    assert r.where(F.col("site_id") == HOT).count() * 3 >= r.count()


@pytest.mark.parametrize("name,build,sql", [
    ("dedup", lambda r: dedup.dedup_latest(r), O.sql(SKEWED, O.D, body="SELECT * FROM d")),
    ("latest", lambda r: features.latest_n_per_site(dedup.dedup_latest(r), 20)
        .select("site_id", "measurement_time", "vehicle_flow_rate", F.col("rn").cast("long").alias("rn")),
     O.sql(SKEWED, O.D, O.latest(20), body="SELECT site_id, measurement_time, CAST(v AS INTEGER) AS vehicle_flow_rate, rn FROM l")),
    ("ma", lambda r: forecast.ma_forecast(dedup.dedup_latest(r)), O.sql(SKEWED, O.D, *O.ma_ctes("d"), body="SELECT * FROM ma")),
    ("ar1", lambda r: forecast.ar1_forecast(dedup.dedup_latest(r)), O.sql(SKEWED, O.D, *O.ar1_ctes("d"), body="SELECT * FROM ar")),
    ("slot_stats", lambda r: stats.slot_stats(r), O.ORACLE["slot_stats"].replace(O.READINGS, SKEWED)),
])
def test_skewed_results_match(spark, con, name, build, sql):
    res = compare(build(skewed_readings(spark)), con, sql)
    assert res["names"] and res["rows"] == res["oracle_rows"] and res["hash"], res


def test_hot_key_is_reduced_before_the_shuffle(spark):
    p = dedup.dedup_latest(skewed_readings(spark))._jdf.queryExecution().executedPlan().toString()
    lines = p.splitlines()
    exch = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[exch:])
