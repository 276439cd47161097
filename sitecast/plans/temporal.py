"""Queries over irregular times, subtotals, sketches, change feeds and SQL
functions, each with its DuckDB SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.operators import dedup, summaries, temporal
from sitecast.operators.temporal import DAY, HOUR
from sitecast.plans import functions
from sitecast.session import scratch_path
from sitecast.sources import tables

RECOVERY_HOURS = 6      # a good reading this soon after a bad one ends the alarm
GAP_HOURS = 8           # silence that ends a site's session
FRAME_HOURS = 12        # trailing mean
LAG_HOURS = 24          # value a day before
MAX_ALARM_HOURS = 48
STATES = (dt.datetime(2024, 1, 12), dt.datetime(2024, 1, 13))   # two states of the history
STATE_DAYS = 14         # slots before this many days belong to the compared part
QUANTILES = (0.1, 0.5, 0.9)
#: Errors that a sketch may show: four standard errors of the distinct count,
#: and twice the rank error that the quantile sketch is built for.
DISTINCT_ERROR, RANK_ERROR = 4 * 1.04 / 2 ** (summaries.LG_K / 2), 0.0333


def _good(r: DataFrame) -> DataFrame:
    return r.where(F.col("data_quality") == "good")


def _bad(r: DataFrame) -> DataFrame:
    return r.where(F.col("data_quality") == "bad").select("event_id", "site_id", "modified_time")


def q_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bad reading with the newest good one of its site at or before it."""
    r = tables.readings(spark, sf_dir)
    return temporal.asof_join(_bad(r), _good(r), ["site_id"], "modified_time", "modified_time",
                              {"good_event": "event_id", "good_flow": "vehicle_flow_rate", "good_time": "modified_time"},
                              ["event_id"])


def q_asof_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bad reading with the first good one of its site after it, if that
    comes within the recovery time."""
    r = tables.readings(spark, sf_dir)
    return temporal.asof_join(_bad(r), _good(r), ["site_id"], "modified_time", "modified_time",
                              {"good_event": "event_id", "good_time": "modified_time"}, ["event_id"],
                              direction="forward", tolerance=RECOVERY_HOURS * HOUR)


def q_value_at_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading with the flow known a day before, nulls skipped (the flow
    of bad readings counts as null)."""
    r = tables.readings(spark, sf_dir).select(
        "event_id", "site_id", "modified_time",
        F.when(F.col("data_quality") == "good", F.col("vehicle_flow_rate")).alias("flow"))
    return temporal.value_at_lag(r, ["site_id"], "modified_time", "flow", LAG_HOURS * HOUR, ["event_id"])


def _alarms(r: DataFrame, tag: str) -> DataFrame:
    """Each bad reading opens an alarm of 1 to MAX_ALARM_HOURS hours."""
    hours = F.coalesce(F.pmod("k", F.lit(MAX_ALARM_HOURS)), F.lit(0)) + 1
    return r.where(F.col("data_quality") == "bad").select(
        F.col("event_id").alias(f"alarm{tag}"), "site_id", F.col("modified_time").alias(f"from{tag}"),
        F.timestamp_add("HOUR", hours, F.col("modified_time")).alias(f"to{tag}"))


def q_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good readings within each alarm of their site."""
    r = tables.readings(spark, sf_dir)
    points = _good(r).select("event_id", "site_id", "modified_time")
    return temporal.interval_join(points, _alarms(r, ""), ["site_id"], "modified_time", "from", "to").select(
        "alarm", "event_id", "site_id")


def q_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of alarms of one site that overlap."""
    r = tables.readings(spark, sf_dir)
    pairs = temporal.overlap_join(_alarms(r, "_a"), _alarms(r, "_b"), ["site_id"], ("from_a", "to_a"), ("from_b", "to_b"))
    return pairs.where(F.col("alarm_a") < F.col("alarm_b")).select("site_id", "alarm_a", "alarm_b")


def q_session_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each site's sessions of readings with less than the gap between them."""
    return temporal.sessions(tables.readings(spark, sf_dir), ["site_id"], "modified_time", GAP_HOURS * HOUR, {
        "n_readings": ("count", "event_id"), "sum_flow": ("sum", "vehicle_flow_rate"), "max_flow": ("max", "vehicle_flow_rate")})


def q_trailing_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean flow and number of a site's readings in the hours up to each one."""
    r = tables.readings(spark, sf_dir).select("event_id", "site_id", "modified_time", "vehicle_flow_rate")
    out = temporal.trailing(r, ["site_id"], "modified_time", FRAME_HOURS * HOUR, {
        "mean_flow": F.avg("vehicle_flow_rate"), "n_in_frame": F.count(F.lit(1))})
    return out.select("event_id", "site_id", F.round("mean_flow", 6).alias("mean_flow"), "n_in_frame")


def _dims(r: DataFrame) -> DataFrame:
    """Readings with a dimension that has real nulls (no lane without k, and
    none for the third lane)."""
    return r.select("site_id", "vehicle_flow_rate", "data_quality", F.to_date("modified_time").alias("day"),
                    F.nullif("specific_lane", F.lit("lane3")).alias("lane"))


def _totals() -> dict:
    return {"n_readings": F.count(F.lit(1)), "n_sites": F.count_distinct("site_id"),
            "sum_flow": F.sum(F.col("vehicle_flow_rate").cast("long")), "n_quality": F.count_distinct("data_quality")}


def q_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by (lane, quality), by day, and over all."""
    dims = ["lane", "data_quality", "day"]
    return summaries.subtotals(_dims(tables.readings(spark, sf_dir)), [dims[:2], dims[2:], []], dims, _totals())


def q_rollup_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = ["day", "lane"]
    return summaries.subtotals(_dims(tables.readings(spark, sf_dir)), summaries.rollup_sets(dims), dims, _totals())


def q_cube_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = ["lane", "data_quality"]
    return summaries.subtotals(_dims(tables.readings(spark, sf_dir)), summaries.cube_sets(dims), dims, _totals())


def _weekly_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored sketches of the days, merged by week."""
    path = scratch_path(spark, "day-sketches")
    r = tables.readings(spark, sf_dir)
    summaries.day_sketches(r, F.to_date("modified_time"), "site_id", "vehicle_flow_rate").write.parquet(path)
    return summaries.merge_sketches(spark.read.parquet(path), F.date_trunc("week", "day").cast("date").alias("week"))


def q_sketch_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct sites a week: the exact number, and whether the merged day
    sketches come within their error of it."""
    exact = tables.readings(spark, sf_dir).groupBy(F.date_trunc("week", "modified_time").cast("date").alias("week")).agg(
        F.count_distinct("site_id").alias("n_sites"))
    error = F.abs(summaries.distinct_estimate() - F.col("n_sites"))
    return _weekly_sketches(spark, sf_dir).join(exact, "week").select(
        "week", F.col("n").alias("n_readings"), "n_sites",
        (error <= F.greatest(F.lit(1), F.col("n_sites") * DISTINCT_ERROR)).alias("within_error"))


def q_sketch_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of the flow a week from merged day sketches: whether the share
    of rows below and up to each estimate brackets the quantile within the rank
    error."""
    weeks = _weekly_sketches(spark, sf_dir)
    estimates = None
    for q in QUANTILES:
        part = weeks.select("week", F.lit(q).alias("q"), summaries.quantile_estimate(q).alias("estimate"))
        estimates = part if estimates is None else estimates.unionByName(part)
    r = tables.readings(spark, sf_dir).select(
        F.date_trunc("week", "modified_time").cast("date").alias("week"), "vehicle_flow_rate")
    flow, at = F.col("vehicle_flow_rate"), F.col("estimate")
    ranks = r.join(estimates, "week").groupBy("week", "q").agg(
        F.count(flow).alias("n_readings"), F.avg((flow < at).cast("int")).alias("below"), F.avg((flow <= at).cast("int")).alias("upto"))
    near = (F.col("below") - RANK_ERROR <= F.col("q")) & (F.col("q") <= F.col("upto") + RANK_ERROR)
    return ranks.select("week", "q", "n_readings", near.alias("within_error"))


def _state(r: DataFrame, until: dt.datetime) -> DataFrame:
    """The history as delivered before ``until``; a site's readings of bad
    quality are taken out again a day later."""
    late = F.lit(until - dt.timedelta(days=1))
    seen = r.where((F.col("modified_time") < F.lit(until))
                   & ~((F.col("data_quality") == "bad") & (F.col("modified_time") < late)))
    slots = seen.withColumn("measurement_time", F.date_trunc("day", "modified_time").cast("timestamp_ntz"))
    return dedup.dedup_latest(slots).select("site_id", "measurement_time", "vehicle_flow_rate", "data_quality")


def q_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed in the history between two states."""
    r = tables.readings(spark, sf_dir)
    before, after = (_state(r, t) for t in STATES)
    return summaries.change_feed(before, after, ["site_id", "measurement_time"])


def q_unchanged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in both states, keys left out, as often as both hold them."""
    r = tables.readings(spark, sf_dir)
    before, after = (_state(r, t).select("site_id", "vehicle_flow_rate", "data_quality") for t in STATES)
    return summaries.unchanged(before, after)


def q_sql_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest readings per site through the SQL table function."""
    functions.register(spark, sf_dir)
    return spark.sql("SELECT site_id, measurement_time, vehicle_flow_rate, CAST(rn AS BIGINT) AS rn FROM latest_readings(3)")


def q_sql_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot statistics of one range through composed SQL table functions."""
    functions.register(spark, sf_dir)
    return spark.sql("""SELECT s.*, n_bad FROM slot_statistics(min_readings => 2) s JOIN (
        SELECT measurement_time, count_if(data_quality = 'bad') AS n_bad
        FROM readings_between(TIMESTAMP_NTZ'2024-01-10', TIMESTAMP_NTZ'2024-01-20') GROUP BY measurement_time)
        USING (measurement_time)""")


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}


# -- DuckDB SQL ---------------------------------------------------------------------

def _oracle() -> dict[str, str]:
    from sitecast.plans.oracle import D, READINGS, sql
    bad = "bad AS (SELECT event_id, site_id, modified_time FROM readings WHERE data_quality = 'bad')"
    good = """good AS (SELECT * FROM readings WHERE data_quality = 'good' QUALIFY row_number() OVER (
      PARTITION BY site_id, modified_time ORDER BY event_id DESC) = 1)"""
    alarms = f"""alarms AS (SELECT event_id AS alarm, site_id, modified_time AS t0,
      modified_time + to_hours(CAST(coalesce(((k % {MAX_ALARM_HOURS}) + {MAX_ALARM_HOURS}) % {MAX_ALARM_HOURS}, 0) + 1 AS BIGINT)) AS t1
      FROM readings WHERE data_quality = 'bad')"""
    dims = """dims AS (SELECT site_id, vehicle_flow_rate, data_quality, CAST(modified_time AS DATE) AS day,
      nullif(specific_lane, 'lane3') AS lane FROM readings)"""

    def totals(names: list[str], sets: str) -> str:
        return sql(READINGS, dims, body=f"""SELECT {', '.join(names)}, count(*) AS n_readings, count(DISTINCT site_id) AS n_sites,
          sum(vehicle_flow_rate)::BIGINT AS sum_flow, count(DISTINCT data_quality) AS n_quality,
          {', '.join(f"grouping({c}) = 1 AS {c}_all" for c in names)} FROM dims GROUP BY {sets}""")

    def state(name: str, until: dt.datetime) -> str:
        return f"""{name} AS (SELECT site_id, date_trunc('day', modified_time) AS measurement_time, vehicle_flow_rate, data_quality
          FROM readings WHERE modified_time < TIMESTAMP '{until}'
            AND NOT (data_quality = 'bad' AND modified_time < TIMESTAMP '{until - dt.timedelta(days=1)}')
          QUALIFY row_number() OVER (PARTITION BY site_id, date_trunc('day', modified_time)
                                     ORDER BY modified_time DESC, event_id DESC) = 1)"""

    states = [state("a", STATES[0]), state("b", STATES[1])]
    new_old = ["n AS (SELECT * FROM b EXCEPT ALL SELECT * FROM a)", "o AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b)"]
    week = "CAST(date_trunc('week', modified_time) AS DATE)"
    return {
        "asof_join": sql(READINGS, bad, good, body="""SELECT bad.*, good.event_id AS good_event,
          good.vehicle_flow_rate AS good_flow, good.modified_time AS good_time FROM bad ASOF LEFT JOIN good
          ON bad.site_id = good.site_id AND bad.modified_time >= good.modified_time"""),
        "asof_next": sql(READINGS, bad, good, f"""hit AS (SELECT bad.*, good.event_id AS e, good.modified_time AS t
          FROM bad ASOF LEFT JOIN good ON bad.site_id = good.site_id AND bad.modified_time <= good.modified_time)""",
                         body=f"""SELECT event_id, site_id, modified_time,
          CASE WHEN t <= modified_time + INTERVAL {RECOVERY_HOURS} HOUR THEN e END AS good_event,
          CASE WHEN t <= modified_time + INTERVAL {RECOVERY_HOURS} HOUR THEN t END AS good_time FROM hit"""),
        "value_at_lag": sql(READINGS, good, """every AS (SELECT event_id, site_id, modified_time,
          CASE WHEN data_quality = 'good' THEN vehicle_flow_rate END AS flow FROM readings)""",
                            f"""moved AS (SELECT *, modified_time - INTERVAL {LAG_HOURS} HOUR AS t FROM every)""",
                            body="""SELECT moved.event_id, moved.site_id, moved.modified_time, flow,
          good.vehicle_flow_rate AS flow_before FROM moved ASOF LEFT JOIN good
          ON moved.site_id = good.site_id AND moved.t >= good.modified_time"""),
        "interval_join": sql(READINGS, alarms, body="""SELECT alarm, event_id, r.site_id FROM readings r JOIN alarms a
          ON r.site_id = a.site_id AND r.modified_time >= t0 AND r.modified_time < t1 WHERE data_quality = 'good'"""),
        "overlap_join": sql(READINGS, alarms, body="""SELECT a.site_id, a.alarm AS alarm_a, b.alarm AS alarm_b
          FROM alarms a JOIN alarms b ON a.site_id = b.site_id AND a.alarm < b.alarm AND a.t0 < b.t1 AND b.t0 < a.t1"""),
        "session_activity": session_sql("readings"),
        "trailing_mean": sql(READINGS, body=f"""SELECT event_id, site_id, round(avg(vehicle_flow_rate) OVER w, 6) AS mean_flow,
          count(*) OVER w AS n_in_frame FROM readings WINDOW w AS (PARTITION BY site_id ORDER BY modified_time
          RANGE BETWEEN INTERVAL {FRAME_HOURS} HOUR PRECEDING AND CURRENT ROW)"""),
        "grouping_sets": totals(["lane", "data_quality", "day"], "GROUPING SETS ((lane, data_quality), (day), ())"),
        "rollup_totals": totals(["day", "lane"], "ROLLUP (day, lane)"),
        "cube_totals": totals(["lane", "data_quality"], "CUBE (lane, data_quality)"),
        "sketch_distinct": sql(READINGS, body=f"""SELECT {week} AS week, count(*) AS n_readings,
          count(DISTINCT site_id) AS n_sites, true AS within_error FROM readings GROUP BY 1"""),
        "sketch_quantiles": sql(READINGS, body=f"""SELECT {week} AS week, q, count(vehicle_flow_rate) AS n_readings,
          true AS within_error FROM readings, (SELECT unnest([{', '.join(f'{q}::DOUBLE' for q in QUANTILES)}]) AS q) GROUP BY 1, 2"""),
        "change_feed": sql(READINGS, *states, *new_old, body="""
          SELECT CASE WHEN (site_id, measurement_time) IN (SELECT (site_id, measurement_time) FROM a) THEN 'changed_to'
                 ELSE 'inserted' END AS kind, * FROM n UNION ALL
          SELECT CASE WHEN (site_id, measurement_time) IN (SELECT (site_id, measurement_time) FROM b) THEN 'changed_from'
                 ELSE 'removed' END AS kind, * FROM o"""),
        "unchanged_rows": sql(READINGS, *states, body="""SELECT site_id, vehicle_flow_rate, data_quality FROM a
          INTERSECT ALL SELECT site_id, vehicle_flow_rate, data_quality FROM b"""),
        "sql_latest": sql(READINGS, D, body="""SELECT site_id, measurement_time, vehicle_flow_rate,
          row_number() OVER (PARTITION BY site_id ORDER BY measurement_time DESC) AS rn FROM d QUALIFY rn <= 3"""),
        "sql_slots": sql(READINGS, body="""SELECT measurement_time, round(avg(vehicle_flow_rate), 6) AS avg_vehicle_flow_rate,
          round(stddev_samp(vehicle_flow_rate), 6) AS std_vehicle_flow_rate, count(*) AS n_readings,
          count(*) FILTER (data_quality = 'bad' AND modified_time >= TIMESTAMP '2024-01-10'
                           AND modified_time < TIMESTAMP '2024-01-20') AS n_bad
          FROM readings GROUP BY measurement_time HAVING count(*) >= 2 AND count(*) FILTER (
            modified_time >= TIMESTAMP '2024-01-10' AND modified_time < TIMESTAMP '2024-01-20') > 0"""),
    }


def session_sql(source: str, where: str = "true") -> str:
    from sitecast.plans.oracle import READINGS, sql
    return sql(READINGS, f"""opened AS (SELECT *, coalesce(modified_time - lag(modified_time) OVER w
      > INTERVAL {GAP_HOURS} HOUR, true) AS opens FROM {source} WINDOW w AS (PARTITION BY site_id ORDER BY modified_time))""",
               """numbered AS (SELECT *, sum(opens::INT) OVER (PARTITION BY site_id ORDER BY modified_time
      ROWS UNBOUNDED PRECEDING) AS n FROM opened)""",
               body=f"""SELECT site_id, min(modified_time) AS session_start,
      max(modified_time) + INTERVAL {GAP_HOURS} HOUR AS session_end, count(event_id) AS n_readings,
      sum(vehicle_flow_rate)::BIGINT AS sum_flow, max(vehicle_flow_rate) AS max_flow
      FROM numbered GROUP BY site_id, n HAVING {where}""")


ORACLE = _oracle()
