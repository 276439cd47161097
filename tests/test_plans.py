"""Plan shape checks: no Python UDF on the hot path, filters and column
pruning reach the scan, dedup reduces map-side, no single-partition window
over row-level data."""

import pytest

from sitecast.plans.registry import all_oracle, all_queries
from tests.conftest import SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def global_windows(text: str) -> list[str]:
    """Window nodes whose rows come from a single-partition exchange: the first
    exchange below the node in the plan tree."""
    lines = [(len(x) - len(x.lstrip(" :+-*()0123456789")), x) for x in text.splitlines() if x.strip()]
    found = []
    for i, (depth, line) in enumerate(lines):
        if "Window " not in line or "WindowGroupLimit" in line:
            continue
        inside = None  # depth of a scalar subquery, whose rows are not the window's
        for below, x in lines[i + 1:]:
            if below <= depth:
                break
            if inside is not None and below > inside:
                continue
            inside = below if "Subquery" in x else None
            if "Exchange" in x and inside is None:
                if "SinglePartition" in x:
                    found.append(line.strip())
                break
    return found


def test_the_window_check_sees_a_global_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(10).repartition(3).withColumn("n", F.row_number().over(Window.orderBy("id")))
    assert global_windows(plan(df))
    fine = spark.range(10).withColumn("n", F.row_number().over(Window.partitionBy((F.col("id") % 3)).orderBy("id")))
    assert not global_windows(plan(fine))


# One row a slot of the model grid, and one row a cycle: bounded by the time range.
SMALL_GLOBAL = {"cross_site_windows", "loss_iteration_rank"}


@pytest.mark.parametrize("name", sorted(set(all_queries()) - SMALL_GLOBAL - {
    n for n in all_queries() if n.startswith("stream_")} - {"upsert_merge", "ingest_xml", "versioned_read", "newest_version"}))
def test_no_python_udf_and_no_global_row_window(spark, name):
    p = plan(all_queries()[name](spark, SMALL))
    assert not any(n in p for n in PY_NODES), p
    assert not global_windows(p), p


def test_model_fits_read_the_newest_rows_only(spark):
    """A partial per-site top-20 stands below the shuffle."""
    lines = plan(all_queries()["ar1_forecast"](spark, SMALL)).splitlines()
    limits = [i for i, x in enumerate(lines) if "WindowGroupLimit" in x and ", 20, Partial" in x]
    assert limits and any("Exchange hashpartitioning(site_id" in x for x in lines[:limits[0]])


def test_time_filter_reaches_scan(spark):
    p = plan(all_queries()["time_range_filter"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p


def test_column_pruning_reaches_scan(spark):
    p = plan(all_queries()["ar1_forecast"](spark, SMALL))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "props" not in scan and "event_type" not in scan


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = all_queries()["dedup_latest"](spark, SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    lines = p.splitlines()
    exch = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert any("WindowGroupLimit" in line and "Partial" in line for line in lines[exch:])


BATCH = [n for n in all_oracle() if not n.startswith("stream_")
         and n not in {"upsert_merge", "ingest_xml", "versioned_read", "newest_version", "forecast_dedup_last"}]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join(spark, name):
    p = plan(all_queries()[name](spark, SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_lookup_join_falls_back_to_a_shuffle_join_above_the_bound(spark):
    from sitecast.operators.joins import lookup_join
    from sitecast.operators.stats import slot_aggregates
    from sitecast.sources import tables
    r = tables.readings(spark, SMALL)
    small = slot_aggregates(r)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        over = lookup_join(r, small, "measurement_time", "left", max_rows=0)
        under = lookup_join(r, small, "measurement_time", "left")
        assert "BroadcastHashJoin" not in plan(over)
        assert "BroadcastHashJoin" in plan(under)
        key = lambda df: sorted(map(tuple, df.select("event_id", "avg_vehicle_flow_rate").collect()))
        assert key(over) == key(under)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
