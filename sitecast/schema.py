"""Fixed schemas of the pipeline's records and tables."""

from pyspark.sql import types as T

# One sensor reading as carried in a JSON message (all nullable).
READING = T.StructType([
    T.StructField("specific_lane", T.StringType()),
    T.StructField("geometry", T.StringType()),
    T.StructField("data_quality", T.StringType()),
    T.StructField("vehicle_flow_rate", T.IntegerType()),
    T.StructField("average_vehicle_speed", T.FloatType()),
    T.StructField("measurement_time", T.TimestampType()),
    T.StructField("modified_time", T.TimestampType()),
    T.StructField("site_id", T.IntegerType()),
])

# Our messages also carry the event id so that ties between two deliveries
# of the same key can be broken deterministically.
MESSAGE = T.StructType([T.StructField("event_id", T.LongType())] + READING.fields)

# The raw record as flattened from a <TrafficFlow> element; every
# child is text.
RAW_FIELDS = ["SiteId", "VehicleFlowRate", "AverageVehicleSpeed",
              "MeasurementTime", "ModifiedTime", "SpecificLane", "Geometry",
              "DataQuality"]
RAW_TEXT = T.StructType([T.StructField("EventId", T.StringType())] +
                        [T.StructField(f, T.StringType()) for f in RAW_FIELDS])

# The reference's field renames (source name -> column name)
# and the six fields it drops when present.
RENAMES = {
    "SpecificLane": "specific_lane",
    "Geometry": "geometry",
    "DataQuality": "data_quality",
    "VehicleFlowRate": "vehicle_flow_rate",
    "AverageVehicleSpeed": "average_vehicle_speed",
    "MeasurementTime": "measurement_time",
    "ModifiedTime": "modified_time",
    "SiteId": "site_id",
}
DROPPED = ["RegionId", "MeasurementOrCalculationPeriod", "VehicleType",
           "MeasurementSide", "Deleted", "CountyNo"]

# Default key of a reading in the history table.
KEY = ("site_id", "measurement_time")
# Total order used to pick the newest delivery of a key.
NEWEST = ("modified_time", "event_id")

FORECAST_COLUMNS = ["site_id", "measurement_time", "vehicle_flow_rate",
                    "forecast_type"]
