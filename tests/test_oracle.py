"""Every query with oracle SQL equals DuckDB on the smoke tables (the driver
runs the same comparison at sf0.01). Streaming / write-backed queries are
covered in test_streaming.py."""

import pytest

import __spark_entry__ as E
from sitecast.plans.compare import compare, duck
from sitecast.plans.registry import all_oracle
from tests.conftest import SMOKE

WRITE_BACKED = {"upsert_merge", "ingest_xml", "versioned_read", "newest_version", "single_file_export"}
ORACLE = all_oracle()
BATCH = sorted(k for k in ORACLE if not k.startswith("stream_") and k not in WRITE_BACKED)


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_oracle(spark, con, name):
    res = compare(E.queries()[name](spark, SMOKE), con, ORACLE[name])
    assert res["names"] and res["types"] and res["rows"] == res["oracle_rows"] and res["hash"], res


def test_every_query_is_registered_and_oracles_are_a_subset():
    q = E.queries()
    assert set(ORACLE) == set(q) - {n for n in q if n.startswith("op") or n == "pipeline"}
    assert len(q) >= 60


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["site_id", "measurement_time", "vehicle_flow_rate", "forecast_type"]
    assert df.count() > 0
