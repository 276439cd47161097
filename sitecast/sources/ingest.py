"""Ingest: XML records, JSON messages, strict coercion with rejects, renames,
bounded pulls, and the stream source switch (S1-S9, P1-P3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.functions.columns import iso_time, strict_float, strict_int
from sitecast.schema import DROPPED, MESSAGE, RAW_TEXT, RENAMES
from sitecast.session import require_utc, scratch_path

ROW_TAG = "TrafficFlow"  # fixed value: the record element
# Written times keep microseconds (the default pattern stops at millis);
# reading uses Spark's default ISO parsing, which accepts an offset.
JSON_WRITE = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
              "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


# -- S2 / S3 ----------------------------------------------------------------

def pull_filter(df: DataFrame, start=None, end=None, site_id=None, region_id=None,
                time: str = "measurement_time", site: str = "site_id", region: str = "region_id") -> DataFrame:
    """``time > start AND time < end [AND site = s] [AND region = r]``;
    each conjunct optional. Plain ``where`` so it reaches the scan."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(time) > F.lit(start))
    if end is not None:
        cond = cond & (F.col(time) < F.lit(end))
    if site_id is not None:
        cond = cond & (F.col(site) == F.lit(site_id))
    if region_id is not None:
        cond = cond & (F.col(region) == F.lit(region_id))
    return df.where(cond)


def bounded_pull(df: DataFrame, n: int, order=("measurement_time", "site_id", "event_id")) -> DataFrame:
    """S3: row cap. The order makes it deterministic; Spark plans it as a
    per-partition top-n followed by a merge of n rows per partition."""
    return df.orderBy(*order).limit(n)


# -- S1 / S4 / S5 / S6: records ---------------------------------------------

def text_records(readings: DataFrame) -> DataFrame:
    """The flattened ``<TrafficFlow>`` record: every child as text, as an XML
    response delivers it (rendered here from readings)."""
    return readings.select(
        F.col("event_id").cast("string").alias("EventId"),
        F.col("site_id").cast("string").alias("SiteId"),
        F.col("vehicle_flow_rate").cast("string").alias("VehicleFlowRate"),
        F.col("k").cast("string").alias("AverageVehicleSpeed"),
        F.date_format("measurement_time", "yyyy-MM-dd'T'HH:mm:ss").alias("MeasurementTime"),
        F.date_format("modified_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ModifiedTime"),
        F.col("specific_lane").alias("SpecificLane"),
        F.col("geometry").alias("Geometry"),
        F.col("data_quality").alias("DataQuality"))


def coerce_text(raw: DataFrame) -> DataFrame:
    """S4 + S5: strict typing of the text record, renamed to snake case.

    int/float need clean numeric text (``60.0`` in an int field -> null),
    times are ISO-8601 (an offset is shifted to UTC). ``rejected`` marks rows
    without a usable key or with a field that failed to parse; split them
    with ``split_rejects``.
    """
    require_utc(raw.sparkSession)
    typed = raw.select(
        strict_int("EventId", "long").alias("event_id"),
        strict_int("SiteId").alias("site_id"),
        strict_int("VehicleFlowRate").alias("vehicle_flow_rate"),
        strict_float("AverageVehicleSpeed").alias("average_vehicle_speed"),
        iso_time("MeasurementTime").alias("measurement_time"),
        iso_time("ModifiedTime").alias("modified_time"),
        F.col("SpecificLane").alias("specific_lane"),
        F.col("Geometry").alias("geometry"),
        F.col("DataQuality").alias("data_quality"),
        # which text fields were present but did not parse
        ((F.col("EventId").isNotNull() & strict_int("EventId", "long").isNull())
         | (F.col("SiteId").isNotNull() & strict_int("SiteId").isNull())
         | (F.col("VehicleFlowRate").isNotNull() & strict_int("VehicleFlowRate").isNull())
         | (F.col("AverageVehicleSpeed").isNotNull() & strict_float("AverageVehicleSpeed").isNull())
         | (F.col("MeasurementTime").isNotNull() & iso_time("MeasurementTime").isNull())
         | (F.col("ModifiedTime").isNotNull() & iso_time("ModifiedTime").isNull())).alias("_bad"))
    rejected = F.col("_bad") | F.col("site_id").isNull() | F.col("measurement_time").isNull()
    return typed.withColumn("rejected", rejected).drop("_bad")


def split_rejects(coerced: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (coerced.where(~F.col("rejected")).drop("rejected"),
            coerced.where(F.col("rejected")))


def source_records(readings: DataFrame) -> DataFrame:
    """A typed record with the source's field names, including the six
    fields the pipeline does not keep (constant here)."""
    return readings.select(
        "event_id",
        F.col("site_id").alias("SiteId"),
        F.col("vehicle_flow_rate").alias("VehicleFlowRate"),
        F.col("average_vehicle_speed").alias("AverageVehicleSpeed"),
        F.col("measurement_time").alias("MeasurementTime"),
        F.col("modified_time").alias("ModifiedTime"),
        F.col("specific_lane").alias("SpecificLane"),
        F.col("geometry").alias("Geometry"),
        F.col("data_quality").alias("DataQuality"),
        F.lit(4).alias("RegionId"),
        F.lit("PT1M").alias("MeasurementOrCalculationPeriod"),
        F.lit("anyVehicle").alias("VehicleType"),
        F.lit("northBound").alias("MeasurementSide"),
        F.lit(False).alias("Deleted"),
        F.lit(1).alias("CountyNo"))


def rename_project(df: DataFrame) -> DataFrame:
    """Rename the eight fields, drop the six unused ones if present."""
    return df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns}).drop(*DROPPED)


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    """Every ``<TrafficFlow>`` element; direct children -> text columns.
    An explicit all-text schema: no inference pass, values kept verbatim."""
    return (spark.read.format("xml").option("rowTag", ROW_TAG)
            .option("nullValue", "").schema(RAW_TEXT).load(path))


def write_xml(raw: DataFrame, path: str) -> None:
    """Text records -> XML documents (``<RESPONSE>`` root, one
    ``<TrafficFlow>`` element per record) with Spark's XML writer."""
    (raw.write.mode("overwrite").format("xml").option("rootTag", "RESPONSE")
     .option("rowTag", ROW_TAG).save(path))


def ingest_xml_roundtrip(spark: SparkSession, readings: DataFrame, rejects_path: str | None = None) -> DataFrame:
    """Write readings as XML documents to the shared folder, scan them back
    with the XML source, coerce and rename (S1 -> S4 -> S5). Records that do not
    parse are written to ``rejects_path`` as they came."""
    path = scratch_path(spark, "xml-landing")
    write_xml(text_records(readings), path)
    good, bad = split_rejects(coerce_text(read_xml(spark, path)))
    bad.write.mode("overwrite").parquet(rejects_path or scratch_path(spark, "xml-rejects"))
    return good


# -- S7 / P1-P3: JSON messages ----------------------------------------------

def encode_json(readings: DataFrame) -> DataFrame:
    """One JSON document per reading in a binary ``value`` (un-keyed),
    the shape a topic sink takes; times keep microseconds."""
    fields = [c.name for c in MESSAGE.fields]
    return readings.select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(F.struct(*fields), JSON_WRITE).cast("binary").alias("value"))


def write_messages(messages: DataFrame, sink: str = "files", path: str | None = None,
                   servers: str | None = None, topic: str | None = None) -> None:
    """S7 sink: append encoded messages to a topic when the connector is on the
    classpath, else to a directory of JSON text files (the two forms that
    ``message_stream`` reads)."""
    if sink == "kafka":
        (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).save())
    else:
        messages.select(F.col("value").cast("string").alias("value")).write.mode("append").text(path)


def json_fields_as_text(msgs: DataFrame) -> DataFrame:
    """Read single fields back out of encoded messages as text."""
    s = F.col("value").cast("string")
    pick = [("event_id", "$.event_id"), ("site_id", "$.site_id"),
            ("vehicle_flow_rate", "$.vehicle_flow_rate"),
            ("average_vehicle_speed", "$.average_vehicle_speed"),
            ("measurement_time", "$.measurement_time"), ("modified_time", "$.modified_time"),
            ("data_quality", "$.data_quality"), ("specific_lane", "$.specific_lane")]
    return msgs.select(*[F.get_json_object(s, p).alias(n) for n, p in pick])


def parse_json(msgs: DataFrame) -> DataFrame:
    """Binary -> string -> ``from_json`` with the fixed schema
    (permissive: bad text or a mistyped field -> null) -> star expand. Times
    are returned as UTC wall-clock ``timestamp_ntz``."""
    require_utc(msgs.sparkSession)
    parsed = msgs.select(F.from_json(F.col("value").cast("string"), MESSAGE).alias("data"))
    out = parsed.select("data.*")
    return (out.withColumn("measurement_time", F.col("measurement_time").cast("timestamp_ntz"))
               .withColumn("modified_time", F.col("modified_time").cast("timestamp_ntz")))


def valid_messages(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without ``site_id`` or ``measurement_time`` go to rejects (the
    reference let them into the history with null keys)."""
    bad = F.col("site_id").isNull() | F.col("measurement_time").isNull()
    return parsed.where(~bad), parsed.where(bad)


# -- S9: source switch ------------------------------------------------------

def message_stream(spark: SparkSession, source: str = "files", path: str | None = None,
                   servers: str | None = None, topic: str | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of ``value`` messages: from a topic when the connector is on
    the classpath, else from a directory of JSON text files."""
    if source == "kafka":
        return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("subscribe", topic).load().select("key", "value"))
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(F.col("value").cast("binary").alias("value"))
