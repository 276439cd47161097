"""Structured Streaming jobs.

The reference's consumer is a stateless stream whose state lives in the
Parquet history, written from ``foreachBatch`` every 5 minutes. Here every
job has an explicit checkpoint location in the shared folder, every sink
write is idempotent per epoch (replaying a batch after a failure changes
nothing), and the stream queries use ``availableNow`` triggers.

Input: the ``events`` table cut into delivery chunks (optionally with overlapping
re-deliveries). A chunk is a folder with any number of files; the chunks arrive
one after the other and each is one epoch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitecast.functions.columns import version_from_name
from sitecast.operators import dedup, features, forecast, reshape, stats
from sitecast.schema import KEY
from sitecast.session import child_names, cut_lineage, move_path, path_exists, scratch_path
from sitecast.sources import history, ingest, tables, versioned
from sitecast.sources.upserts import UpsertTable

PROCESSING_TIME = "5 minutes"   # reference trigger period
N_EPOCHS = 4                    # epoch merge width
N_FILES = 6                     # delivery chunks landed for the stream queries
MODEL_ROWS = 20                 # readings of each site that the models take
OVERLAP = 0.3                   # share of the next chunk delivered again
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# -- landing ------------------------------------------------------------------

def chunk_span_us(lo, hi, n_files: int) -> int:
    """Microseconds per delivery chunk, in exact integer arithmetic."""
    delta = hi - lo
    total = (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
    return max(total // n_files, 1)


def land_events(spark: SparkSession, sf_dir: str, n_files: int = 6, overlap: float = 0.0,
                root: str | None = None, delayed: str | None = None) -> str:
    """Cut ``events`` into ``n_files`` consecutive delivery chunks (by event
    time). Each chunk also re-delivers the first ``overlap`` fraction of the next
    one; rows for which the SQL condition ``delayed`` holds come one chunk later.
    One job writes all chunks, each as a folder of many files, to a staging
    folder beside the landing; ``run_arrivals`` lets them in one at a time.
    Returns the landing directory."""
    ev = tables.table(spark, sf_dir, "events")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    span_us = chunk_span_us(lo, hi, n_files)
    start = F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz")
    pos = F.timestamp_diff("MICROSECOND", start, F.col("ts")) / F.lit(span_us)
    chunk = F.least(F.floor(pos), F.lit(n_files - 1)).cast("int")
    # a row in the head of chunk c (c > 0) is delivered again with chunk c-1
    redelivered = (chunk > 0) & (pos - chunk < F.lit(overlap))
    first = chunk if delayed is None else F.when(F.expr(delayed), F.least(chunk + 1, F.lit(n_files - 1))).otherwise(chunk)
    chunks = F.when(redelivered, F.array(first, chunk - 1)).otherwise(F.array(first))
    root = root or scratch_path(spark, "landing")
    (ev.withColumn("chunk", F.explode(chunks)).write.mode("overwrite").partitionBy("chunk")
     .parquet(f"{root}/_staged"))
    return root


def staged_chunks(spark: SparkSession, landing: str) -> list[str]:
    """Chunks that have not arrived yet, in order."""
    names = [n for n in child_names(spark, f"{landing}/_staged") if n.startswith("chunk=")]
    return sorted(names, key=lambda n: int(n[len("chunk="):]))


def event_stream(spark: SparkSession, landing: str) -> DataFrame:
    """File-stream source over the arrived chunks (a glob: the source needs a
    directory or pattern), with the chunk number as a column."""
    folder = landing if any(n.startswith("chunk=") for n in child_names(spark, landing)) else f"{landing}/_staged"
    fields = spark.read.option("basePath", folder).parquet(f"{folder}/chunk=*").drop("chunk").schema.fields
    schema = T.StructType([*fields, T.StructField("chunk", T.IntegerType())])
    return spark.readStream.schema(schema).option("basePath", landing).parquet(f"{landing}/chunk=*/*.parquet")


def _run(spark: SparkSession, writer, checkpoint: str, available_now: bool = True,
         state_partitions: int | None = None, settings: dict[str, str] | None = None):
    """Start a query with an explicit checkpoint. For stateful queries the
    number of state partitions is fixed at the first start (then kept by the
    checkpoint); it defaults to the cluster's parallelism rather than to the
    batch shuffle setting, which sizes shuffles, not state stores. Their state
    is kept in RocksDB, outside the JVM heap. ``settings`` hold for this query."""
    w = writer.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=PROCESSING_TIME)
    settings = dict(settings or {})
    if state_partitions is not None:
        settings |= {"spark.sql.shuffle.partitions": str(state_partitions),
                    "spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        q = w.start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    if available_now:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return q


def arrivals(spark: SparkSession, landing: str) -> Iterator[str | None]:
    """Let the staged chunks in one at a time; one turn with nothing new if none
    is staged."""
    names = staged_chunks(spark, landing)
    for name in names:
        move_path(spark, f"{landing}/_staged/{name}", f"{landing}/{name}")
        yield name
    if not names:
        yield None


def run_arrivals(spark: SparkSession, landing: str, writer, checkpoint: str,
                 state_partitions: int | None = None) -> None:
    """One run for each chunk that arrives, so every chunk is one epoch however
    many files it has. With nothing staged, one run takes whatever files are new."""
    for _ in arrivals(spark, landing):
        _run(spark, writer, checkpoint, state_partitions=state_partitions)


def state_partitions(spark: SparkSession) -> int:
    """State stores per stateful operator: one per core of the cluster."""
    return max(2, spark.sparkContext.defaultParallelism)


# -- X1, X4-X6, S13: the history upsert stream --------------------------------

def run_upsert_stream(spark: SparkSession, landing: str, history_path: str, checkpoint: str,
                      available_now: bool = True, stats_scope: str = "merged",
                      max_lateness: str | None = None):
    """Readings -> ``foreachBatch`` upsert into the history table. No
    watermark by default: late rows are merged whenever they arrive; with
    ``max_lateness`` a watermark + within-watermark dedup bounds state and
    drops rows later than that (X3)."""
    src = tables.events_to_readings(event_stream(spark, landing))
    if max_lateness:
        src = (src.withColumn("_event_time", F.col("modified_time").cast("timestamp"))
               .withWatermark("_event_time", max_lateness)
               .dropDuplicatesWithinWatermark(["site_id", "measurement_time", "event_id"])
               .drop("_event_time"))

    def merge(batch: DataFrame, epoch_id: int) -> None:
        history.upsert(spark, batch, history_path, epoch_id, stats_scope=stats_scope)

    writer = src.writeStream.foreachBatch(merge)
    if not available_now:
        return _run(spark, writer, checkpoint, available_now=False)
    run_arrivals(spark, landing, writer, checkpoint, state_partitions(spark) if max_lateness else None)


def q_stream_upsert(spark, sf_dir):
    landing = land_events(spark, sf_dir, n_files=N_FILES, overlap=OVERLAP)
    hist = scratch_path(spark, "history")
    run_upsert_stream(spark, landing, hist, scratch_path(spark, "ckpt"))
    return history.read_history(spark, hist)


# -- X3 ---------------------------------------------------------------------

def q_stream_dedup(spark, sf_dir, watermark: str | None = None):
    """Keys seen, deduplicated inside the stream with bounded state (X3, the
    option with a watermark). A watermark drops rows that come later than it
    allows; the default is the whole time span of the events, so that none
    can."""
    if watermark is None:
        lo, hi = tables.table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
        watermark = f"{(hi - lo).days + 1} days"
    landing = land_events(spark, sf_dir, n_files=N_FILES, overlap=OVERLAP)
    out = scratch_path(spark, "dedup-out")
    src = (tables.events_to_readings(event_stream(spark, landing))
           .withColumn("_event_time", F.col("modified_time").cast("timestamp"))
           .withWatermark("_event_time", watermark)
           .dropDuplicatesWithinWatermark(["site_id", "measurement_time"])
           .select("site_id", "measurement_time"))
    run_arrivals(spark, landing, src.writeStream.format("parquet").option("path", out).outputMode("append"),
                 scratch_path(spark, "ckpt"), state_partitions(spark))
    return spark.read.parquet(out)


# -- X9 ---------------------------------------------------------------------

def q_stream_slot_stats(spark, sf_dir):
    """Running per-slot mean/std over everything delivered (complete mode;
    state is one aggregate buffer per slot). Each epoch replaces the output
    table with the current totals."""
    landing = land_events(spark, sf_dir, n_files=N_FILES, overlap=0.0)
    out = scratch_path(spark, "slot-stats")
    agg = (tables.events_to_readings(event_stream(spark, landing))
           .groupBy("measurement_time")
           .agg(F.avg("vehicle_flow_rate").alias("_avg"), F.stddev_samp("vehicle_flow_rate").alias("_std"),
                F.count(F.lit(1)).alias("n_readings")))

    def publish(batch: DataFrame, epoch_id: int) -> None:
        (batch.select("measurement_time", F.round("_avg", 6).alias("avg_vehicle_flow_rate"),
                      F.round("_std", 6).alias("std_vehicle_flow_rate"), "n_readings")
         .write.mode("overwrite").parquet(out))

    run_arrivals(spark, landing, agg.writeStream.outputMode("complete").foreachBatch(publish),
                 scratch_path(spark, "ckpt"), state_partitions(spark))
    return spark.read.parquet(out)


# -- S12 / X7: per-epoch snapshots and the epoch window ------------------------

def write_snapshot(readings: DataFrame, root: str, epoch: int) -> None:
    """The slot-mean filled grid of a micro-batch of readings, from any source,
    under the epoch that ``foreachBatch`` gives it. A replay replaces its own
    epoch; the snapshots below ``root`` belong to one checkpoint."""
    d = dedup.dedup_latest(readings)
    # the epoch's own folder: a write by partition columns would sort the grid first
    reshape.impute_slot_mean(d).write.mode("overwrite").parquet(f"{root}/snapshots/epoch={int(epoch)}")


def q_stream_snapshots(spark, sf_dir):
    landing = land_events(spark, sf_dir, n_files=N_FILES, overlap=OVERLAP)
    root = scratch_path(spark, "epochs")
    run_arrivals(spark, landing, tables.events_to_readings(event_stream(spark, landing)).writeStream.foreachBatch(
        lambda batch, epoch_id: write_snapshot(batch, root, epoch_id)), scratch_path(spark, "ckpt"))
    return spark.read.parquet(f"{root}/snapshots").drop("imputed")


def window_of_epochs(spark: SparkSession, root: str, epoch: int, n_epochs: int = N_EPOCHS) -> DataFrame | None:
    """The merge of the last n epochs' snapshots, from epoch n on: the newest
    reading of each cell wins, and fills are made anew for the window."""
    if epoch < n_epochs:
        return None
    first = epoch - n_epochs + 1
    snaps = spark.read.parquet(f"{root}/snapshots").where(F.col("epoch").between(first, epoch))
    cells = snaps.withColumn("vehicle_flow_rate", F.when(~F.col("imputed"), F.col("vehicle_flow_rate")))
    return reshape.merge_epochs(cells, n_epochs, first_window=first, last_window=F.lit(first))


def q_stream_epoch_window(spark, sf_dir, n_epochs: int = N_EPOCHS):
    """From epoch n on, merge the snapshots of the last n epochs and write the
    result under window = epoch - n + 1."""
    landing = land_events(spark, sf_dir, n_files=N_FILES, overlap=OVERLAP)
    root = scratch_path(spark, "epochs")

    def step(batch: DataFrame, epoch_id: int) -> None:
        write_snapshot(batch, root, epoch_id)
        merged = window_of_epochs(spark, root, epoch_id, n_epochs)
        if merged is not None:
            (merged.drop("window_id").write.mode("overwrite")
             .parquet(f"{root}/merged/window_id={epoch_id - n_epochs + 1}"))

    run_arrivals(spark, landing, tables.events_to_readings(event_stream(spark, landing)).writeStream.foreachBatch(step),
                 scratch_path(spark, "ckpt"))
    return spark.read.parquet(f"{root}/merged")


# -- T8: forecast on new data -------------------------------------------------

def forecast_step(spark: SparkSession, hist: str, out: str, lookback_days: int | None = None) -> Callable[[], None]:
    """The per-cycle model step (T8): forecast only if the newest slot moved
    since the last version (the new-data gate), then write the next version
    and the loss row of the newest cycle.

    ``lookback_days`` bounds the work of a cycle by reading only the newest
    dates of the history (pruned); a site silent for longer gets no forecast.
    The default reads the whole history, as the reference does."""
    def step() -> None:
        newest = history.newest_slot(spark, hist)
        if newest is None:
            return
        version = 1
        if path_exists(spark, f"{out}/cutoffs"):
            seen = spark.read.parquet(f"{out}/cutoffs").agg(F.max("cutoff"), F.max("version")).first()
            if seen[0] is not None and seen[0] >= newest:
                return
            version = seen[1] + 1
        since = None if lookback_days is None else newest.date() - dt.timedelta(days=lookback_days)
        d = history.read_history(spark, hist, stats=False, since=since).select(*KEY, "vehicle_flow_rate")
        # the forecasters read the newest rows of each site, the loss those of the newest day and a window
        # of each site before it: the history is merged once, these are stored and read by all of them
        day = newest.replace(hour=0, minute=0, second=0, microsecond=0)
        recent = cut_lineage(features.newest_rows(d, MODEL_ROWS, day))
        versioned.write_version(forecast.forecast_table(recent, history=MODEL_ROWS, min_history=MODEL_ROWS), out, version)
        versioned.append_loss(forecast.newest_loss(recent, newest=newest), out)
        (spark.createDataFrame([(version, newest)], "version int, cutoff timestamp_ntz")
         .write.mode("append").parquet(f"{out}/cutoffs"))
    return step


def q_stream_forecast(spark, sf_dir):
    """Each epoch upserts the history, then runs the model step."""
    landing = land_events(spark, sf_dir, n_files=N_FILES, overlap=OVERLAP)
    hist = scratch_path(spark, "history")
    out = scratch_path(spark, "forecasts")
    model = forecast_step(spark, hist, out)

    def step(batch: DataFrame, epoch_id: int) -> None:
        history.upsert(spark, tables.events_to_readings(batch), hist, epoch_id)
        model()

    run_arrivals(spark, landing, event_stream(spark, landing).writeStream.foreachBatch(step),
                 scratch_path(spark, "ckpt"))
    return versioned.read_versions(spark, out)


# -- X8: incremental pickup of forecast versions -------------------------------

def _write_versions(spark, sf_dir, root: str) -> list[str]:
    """The forecast versions as files below ``root``."""
    from sitecast.plans.catalog import N_VERSIONS, versions_in_memory
    allv = versions_in_memory(spark, sf_dir, N_VERSIONS)
    return [versioned.write_version(allv.where(F.col("version") == v), root, v) for v in range(1, N_VERSIONS + 1)]


def q_versioned_read(spark, sf_dir):
    """Write the forecast versions, read them all back."""
    root = scratch_path(spark, "forecasts")
    _write_versions(spark, sf_dir, root)
    return versioned.read_versions(spark, root)


def q_newest_version(spark, sf_dir):
    """The newest version among the files, by their names."""
    root = scratch_path(spark, "forecasts")
    _write_versions(spark, sf_dir, root)
    return versioned.newest_listed(spark, root)


def accumulated(spark: SparkSession, path: str) -> UpsertTable:
    """The forecasts of all versions, the highest version per key."""
    return UpsertTable(spark, path, ("measurement_time", "site_id", "forecast_type"), ("version",),
                       "forecast_date", lambda: F.to_date("measurement_time"))


def q_stream_accumulate(spark, sf_dir):
    """A file stream over the forecast directory picks up each new
    version as it arrives; every version is one batch, upserted into the
    accumulated table (highest version wins per time, site and forecaster)."""
    staged, root = scratch_path(spark, "forecasts-staged"), scratch_path(spark, "forecasts")
    paths = _write_versions(spark, sf_dir, staged)
    acc = accumulated(spark, scratch_path(spark, "accumulated"))
    checkpoint = scratch_path(spark, "ckpt")
    src = (spark.readStream.schema(versioned.FORECAST_SCHEMA)
           .parquet(f"{root}/{versioned.FILE_PREFIX}_*_prediction.parquet")
           .withColumn("version", version_from_name(F.col("_metadata.file_path"))))
    writer = src.writeStream.foreachBatch(lambda batch, epoch_id: acc.upsert(batch, epoch_id))
    for p in paths:
        move_path(spark, p, f"{root}/{p.rsplit('/', 1)[1]}")
        _run(spark, writer, checkpoint)
    return acc.read().drop("forecast_date")


# -- S9 / S7 / P1-P3: messages through a stream -------------------------------

def q_stream_ingest(spark, sf_dir):
    """JSON messages (as a topic would carry them) landed as text files,
    read as a stream, parsed with the fixed schema; rows without key go to a
    reject table, the rest are appended."""
    landing = scratch_path(spark, "json-landing")
    ingest.write_messages(ingest.encode_json(tables.readings(spark, sf_dir)), "files", landing)
    out = scratch_path(spark, "ingested")
    rejects = scratch_path(spark, "rejects")

    def sink(batch: DataFrame, epoch_id: int) -> None:
        good, bad = ingest.valid_messages(ingest.parse_json(batch))
        # The batch's row count is observed while it is written (no extra job)
        good, obs = stats.observed_metrics(good.withColumn("epoch", F.lit(epoch_id)))
        good.write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out)
        (spark.createDataFrame([(epoch_id, obs.get["n_rows"])], "epoch long, n_rows long")
         .write.mode("overwrite").parquet(f"{out}_metrics/epoch={epoch_id}"))
        bad.withColumn("epoch", F.lit(epoch_id)).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(rejects)

    src = ingest.message_stream(spark, "files", landing)
    _run(spark, src.writeStream.foreachBatch(sink), scratch_path(spark, "ckpt"))
    return spark.read.parquet(out).drop("epoch")


STREAM_QUERIES = {
    "stream_upsert": q_stream_upsert,
    "stream_dedup": q_stream_dedup,
    "stream_slot_stats": q_stream_slot_stats,
    "stream_snapshots": q_stream_snapshots,
    "stream_epoch_window": q_stream_epoch_window,
    "stream_forecast": q_stream_forecast,
    "stream_accumulate": q_stream_accumulate,
    "stream_ingest": q_stream_ingest,
    "versioned_read": q_versioned_read,
    "newest_version": q_newest_version,
}
