"""Event-time streams: session windows, hopping windows with stored late rows, a
join of two streams, and an alarm for silent sites by keyed state with timers.

Every job is append-only with an explicit watermark, so its state is bounded by
the watermark and not by the stream, and a restart goes on from the checkpoint.
A row counts as late by Spark's rule: what it belongs to (a window, a match) has
ended at or before the watermark, which is the newest event time of the earlier
epochs less the delay.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sitecast.session import path_exists, scratch_path
from sitecast.sources import tables
from sitecast.streaming import jobs

DELAY_HOURS = 24        # how far behind the newest row a row may come
GAP_HOURS = 8           # silence that ends a session
WINDOW_HOURS, SLIDE_HOURS = 12, 6
DELAYED = "event_id % 7 = 0"    # rows that the landing delivers one chunk late
MATCH_HOURS = 2         # an actual comes within this time after its forecast
SETTLED_HOURS = 48      # rows this far behind the newest one have their final result
#: Rows are late by the same watermark that closes windows. With several stateful
#: operators Spark lets late rows follow the watermark one batch behind, so a
#: window that has ended could still take rows.
ONE_WATERMARK = {"spark.sql.streaming.statefulOperator.allowMultiple": "false"}
SILENT_HOURS = 24       # a site without a reading for longer raises an alarm


def watermarked(events: DataFrame, delay_hours: int = DELAY_HOURS, name: str = "event_time") -> DataFrame:
    """Readings of an event stream with their time as the event time."""
    return (tables.events_to_readings(events).withColumn(name, F.col("modified_time").cast("timestamp"))
            .withWatermark(name, f"{delay_hours} hours"))


def _ntz(time: Column | str) -> Column:
    return (F.col(time) if isinstance(time, str) else time).cast("timestamp_ntz")


# -- session windows -----------------------------------------------------------

def session_stream(events: DataFrame, gap_hours: int = GAP_HOURS, delay_hours: int = DELAY_HOURS) -> DataFrame:
    """Sessions of each site, each emitted once the watermark has passed its
    end. Equal to ``temporal.sessions`` over the same rows."""
    return (watermarked(events, delay_hours)
            .groupBy("site_id", F.session_window("event_time", f"{gap_hours} hours").alias("s"))
            .agg(F.count("event_id").alias("n_readings"), F.sum("vehicle_flow_rate").alias("sum_flow"),
                 F.max("vehicle_flow_rate").alias("max_flow"))
            .select("site_id", _ntz("s.start").alias("session_start"), _ntz("s.end").alias("session_end"),
                    "n_readings", "sum_flow", "max_flow"))


def q_stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions that the stream has closed."""
    landing = jobs.land_events(spark, sf_dir, n_files=jobs.N_FILES)
    out = scratch_path(spark, "sessions")
    sessions = session_stream(jobs.event_stream(spark, landing))
    jobs.run_arrivals(spark, landing, sessions.writeStream.format("parquet").option("path", out).outputMode("append"),
                      scratch_path(spark, "ckpt"), jobs.state_partitions(spark))
    return spark.read.parquet(out)


# -- hopping windows, late rows ----------------------------------------------------

def _hops(window_hours: int, slide_hours: int) -> Column:
    return F.window("event_time", f"{window_hours} hours", f"{slide_hours} hours")


def hopping_stream(events: DataFrame, window_hours: int = WINDOW_HOURS, slide_hours: int = SLIDE_HOURS,
                   delay_hours: int = DELAY_HOURS) -> DataFrame:
    """Totals of each site and window; a window is emitted once, when the
    watermark passes its end. Rows of windows that have ended are dropped here;
    ``store_late`` keeps them."""
    return (watermarked(events, delay_hours).groupBy("site_id", _hops(window_hours, slide_hours).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_readings"), F.sum("vehicle_flow_rate").alias("sum_flow"))
            .select("site_id", _ntz("w.start").alias("window_start"), _ntz("w.end").alias("window_end"),
                    "n_readings", "sum_flow"))


def store_late(batch: DataFrame, epoch: int, root: str, window_hours: int = WINDOW_HOURS,
               slide_hours: int = SLIDE_HOURS, delay_hours: int = DELAY_HOURS) -> None:
    """Write the (row, window) pairs of a batch that come too late, by the rule
    of the watermark: their window had ended at the newest time of the earlier
    epochs less the delay. The newest time of this epoch is kept beside them.
    Both are written under the epoch, so a replay replaces its own rows."""
    spark = batch.sparkSession
    rows = tables.events_to_readings(batch).withColumn("event_time", F.col("modified_time").cast("timestamp"))
    before = None
    if path_exists(spark, f"{root}/marks"):
        before = spark.read.parquet(f"{root}/marks").where(F.col("epoch") < epoch).agg(F.max("newest")).first()[0]
    (rows.agg(F.date_trunc("millisecond", F.max("event_time")).alias("newest")).withColumn("epoch", F.lit(epoch))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(f"{root}/marks"))
    pairs = rows.select("event_id", "site_id", "vehicle_flow_rate", "modified_time", _hops(window_hours, slide_hours).alias("w"))
    mark = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay_hours} HOURS")
    late = pairs.where(F.col("w.end") <= mark)   # none in the first epoch, which has no mark
    (late.select("event_id", "site_id", "vehicle_flow_rate", "modified_time", _ntz("w.start").alias("window_start"),
                 _ntz("w.end").alias("window_end"), F.lit(epoch).alias("epoch"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(f"{root}/late"))


def run_hopping(spark: SparkSession, landing: str, root: str) -> tuple[DataFrame, DataFrame]:
    """Both streams over every chunk that arrives: (windows, late pairs)."""
    windows = hopping_stream(jobs.event_stream(spark, landing))
    for _ in jobs.arrivals(spark, landing):
        jobs._run(spark, windows.writeStream.format("parquet").option("path", f"{root}/windows").outputMode("append"),
                  f"{root}/ckpt-windows", state_partitions=jobs.state_partitions(spark), settings=ONE_WATERMARK)
        jobs._run(spark, jobs.event_stream(spark, landing).writeStream.foreachBatch(
            lambda batch, epoch: store_late(batch, epoch, root)), f"{root}/ckpt-late")
    return spark.read.parquet(f"{root}/windows"), spark.read.parquet(f"{root}/late")


def _hopping(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    landing = jobs.land_events(spark, sf_dir, n_files=jobs.N_FILES, delayed=DELAYED)
    return run_hopping(spark, landing, scratch_path(spark, "hopping"))


def q_stream_hopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that the stream has emitted."""
    return _hopping(spark, sf_dir)[0]


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (row, window) pairs that came too late for their window."""
    return _hopping(spark, sf_dir)[1].withColumn("epoch", F.col("epoch").cast("long"))


# -- stream-stream join --------------------------------------------------------------

def forecast_join(forecasts: DataFrame, actuals: DataFrame, match_hours: int = MATCH_HOURS) -> DataFrame:
    """Forecasts with the actual readings of their slot, left outer. Both sides
    have a watermark and the times of a match are bounded, so a forecast waits in
    the state for ``match_hours`` and the delay, and is then emitted unmatched."""
    f = forecasts.alias("f")
    a = actuals.alias("a")
    return f.join(a, F.expr(f"""f.site_id = a.a_site_id AND f.target_time = a.a_slot
        AND a.a_time >= f.f_time AND a.a_time <= f.f_time + INTERVAL {match_hours} HOURS"""), "left_outer").select(
        "forecast_id", "site_id", "target_time", "forecast_flow", "actual_id", "actual_flow", _ntz("f_time").alias("made_at"))


def persistence_forecasts(events: DataFrame, delay_hours: int = DELAY_HOURS) -> DataFrame:
    """Every reading as the forecast of its site's next hour."""
    return watermarked(events, delay_hours, "f_time").select(
        F.col("event_id").alias("forecast_id"), "site_id", "f_time", F.col("vehicle_flow_rate").alias("forecast_flow"),
        F.timestamp_add("HOUR", F.lit(1), F.col("measurement_time")).alias("target_time"))


def arriving_actuals(events: DataFrame, delay_hours: int = DELAY_HOURS) -> DataFrame:
    return watermarked(events, delay_hours, "a_time").select(
        F.col("event_id").alias("actual_id"), F.col("site_id").alias("a_site_id"), "a_time",
        F.col("measurement_time").alias("a_slot"), F.col("vehicle_flow_rate").alias("actual_flow"))


def settled(rows: DataFrame, events: DataFrame) -> DataFrame:
    """Rows so old that nothing can change them any more."""
    newest = events.agg(F.max("ts")).scalar()
    return rows.where(F.col("made_at") < F.timestamp_add("HOUR", F.lit(-SETTLED_HOURS), newest))


def q_stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settled forecasts with their actuals, null where none came."""
    landing = jobs.land_events(spark, sf_dir, n_files=jobs.N_FILES)
    out = scratch_path(spark, "stream-join")
    joined = forecast_join(persistence_forecasts(jobs.event_stream(spark, landing)),
                           arriving_actuals(jobs.event_stream(spark, landing)))
    jobs.run_arrivals(spark, landing, joined.writeStream.format("parquet").option("path", out).outputMode("append"),
                      scratch_path(spark, "ckpt"), jobs.state_partitions(spark))
    return settled(spark.read.parquet(out), tables.table(spark, sf_dir, "events")).drop("made_at")


# -- keyed state with timers -----------------------------------------------------------

ALARM = "site_id int, silent_from timestamp, alarm_time timestamp"


class SilentSite(StatefulProcessor):
    """Alarm when a site has no reading for longer than ``silent_ms``.

    State of a site: the time of its newest reading and whether its silence is
    already reported. A timer at newest + silence raises the alarm while the site
    is silent; a gap between readings that arrive together is reported when they
    do. The state of a site goes with its alarm, all but the newest time.

    A batch's rows of a site are kept as first and last time of each stretch of
    ``silent_ms``, which no alarm can lie within, so memory follows the time
    range and not the rows."""

    def __init__(self, silent_us: int):
        self.silent_us = silent_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "newest long, reported boolean")

    def _alarm(self, site: int, newest: int) -> Row:
        from datetime import datetime, timedelta, timezone
        at = lambda us: (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=us))
        return Row(site_id=site, silent_from=at(newest), alarm_time=at(newest + self.silent_us))

    def _timer(self, newest: int) -> int:
        return (newest + self.silent_us) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stretches: dict[int, list[int]] = {}
        for row in rows:
            t = row["micros"]
            s = stretches.setdefault(t // self.silent_us, [t, t])
            s[0], s[1] = min(s[0], t), max(s[1], t)
        state = self.seen.get() if self.seen.exists() else None
        newest, reported = (state[0], state[1]) if state else (None, False)
        before = newest
        for first, last in (stretches[k] for k in sorted(stretches)):
            if newest is not None and first - newest > self.silent_us and not reported:
                yield self._alarm(key[0], newest)
            if newest is None or last > newest:
                newest, reported = last, False
        if newest != before:
            if before is not None and not (state and state[1]):
                self.handle.deleteTimer(self._timer(before))
            self.seen.update((newest, False))
            self.handle.registerTimer(self._timer(newest))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        newest, reported = self.seen.get()
        if not reported and self._timer(newest) <= expiredTimerInfo.getExpiryTimeInMs():
            self.seen.update((newest, True))
            yield self._alarm(key[0], newest)

    def close(self) -> None:
        pass


def silent_site_stream(events: DataFrame, silent_hours: int = SILENT_HOURS, delay_hours: int = DELAY_HOURS) -> DataFrame:
    rows = watermarked(events, delay_hours).where("site_id IS NOT NULL").select(
        "site_id", "event_time", F.unix_micros("event_time").alias("micros"))
    alarms = rows.groupBy("site_id").transformWithState(
        statefulProcessor=SilentSite(silent_hours * 3_600_000_000), outputStructType=ALARM,
        outputMode="Append", timeMode="EventTime")
    return alarms.select("site_id", _ntz("silent_from").alias("silent_from"), _ntz("alarm_time").alias("alarm_time"))


def q_stream_silent_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All alarms that the stream has raised."""
    landing = jobs.land_events(spark, sf_dir, n_files=jobs.N_FILES)
    out = scratch_path(spark, "alarms")
    alarms = silent_site_stream(jobs.event_stream(spark, landing))
    jobs.run_arrivals(spark, landing, alarms.writeStream.format("parquet").option("path", out).outputMode("append"),
                      scratch_path(spark, "ckpt"), jobs.state_partitions(spark))
    return spark.read.parquet(out)


QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}


# -- DuckDB SQL ---------------------------------------------------------------------

def _oracle() -> dict[str, str]:
    from sitecast.plans.oracle import READINGS, landed_ctes, sql
    from sitecast.plans.temporal import session_sql
    n = jobs.N_FILES
    newest = "(SELECT date_trunc('milliseconds', max(ts)) FROM events)"
    pairs = [*landed_ctes(n, 0.0)[:2], f"""landed AS (
      SELECT * EXCLUDE (pos), least(c + (CASE WHEN {DELAYED} THEN 1 ELSE 0 END), {n - 1})::BIGINT AS epoch
      FROM (SELECT *, least(floor(pos), {n - 1}) AS c FROM pos))""",
             READINGS.replace("SELECT event_id,", "SELECT epoch, event_id,", 1).replace("FROM events)", "FROM landed)"),
             f"""marks AS (SELECT epoch, max(date_trunc('milliseconds', max(ts))) OVER (ORDER BY epoch ROWS BETWEEN
               UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL {DELAY_HOURS} HOUR AS mark FROM landed GROUP BY epoch)""",
             f"""pairs AS (SELECT r.*, w AS window_start, w + INTERVAL {WINDOW_HOURS} HOUR AS window_end,
               coalesce(w + INTERVAL {WINDOW_HOURS} HOUR <= mark, false) AS late
               FROM (SELECT *, unnest(generate_series(time_bucket(INTERVAL {SLIDE_HOURS} HOUR, modified_time)
                 - INTERVAL {WINDOW_HOURS - SLIDE_HOURS} HOUR, modified_time, INTERVAL {SLIDE_HOURS} HOUR)) AS w FROM readings) r
               JOIN marks USING (epoch))"""]
    return {
        "stream_sessions": session_sql("readings", f"""max(modified_time) + INTERVAL {GAP_HOURS} HOUR
          <= {newest} - INTERVAL {DELAY_HOURS} HOUR"""),
        "stream_hopping": sql(*pairs, body=f"""SELECT site_id, window_start, window_end, count(*) AS n_readings,
          sum(vehicle_flow_rate)::BIGINT AS sum_flow FROM pairs WHERE NOT late
          AND window_end <= {newest} - INTERVAL {DELAY_HOURS} HOUR GROUP BY ALL"""),
        "stream_late_rows": sql(*pairs, body="""SELECT event_id, site_id, vehicle_flow_rate, modified_time, window_start,
          window_end, epoch FROM pairs WHERE late"""),
        "stream_join": sql(READINGS, body=f"""SELECT f.event_id AS forecast_id, f.site_id,
          f.measurement_time + INTERVAL 1 HOUR AS target_time, f.vehicle_flow_rate AS forecast_flow,
          a.event_id AS actual_id, a.vehicle_flow_rate AS actual_flow
          FROM readings f LEFT JOIN readings a ON f.site_id = a.site_id
            AND a.measurement_time = f.measurement_time + INTERVAL 1 HOUR AND a.modified_time >= f.modified_time
            AND a.modified_time <= f.modified_time + INTERVAL {MATCH_HOURS} HOUR
          WHERE f.modified_time < (SELECT max(ts) FROM events) - INTERVAL {SETTLED_HOURS} HOUR"""),
        "stream_silent_sites": sql(READINGS, f"""gaps AS (SELECT site_id, modified_time, lead(modified_time) OVER (
            PARTITION BY site_id ORDER BY modified_time) AS following FROM readings)""",
                                   body=f"""SELECT site_id, modified_time AS silent_from,
          modified_time + INTERVAL {SILENT_HOURS} HOUR AS alarm_time FROM gaps
          WHERE following - modified_time > INTERVAL {SILENT_HOURS} HOUR OR (following IS NULL
            AND modified_time + INTERVAL {SILENT_HOURS} HOUR < {newest} - INTERVAL {DELAY_HOURS} HOUR)"""),
    }


ORACLE = _oracle()
