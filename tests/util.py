import datetime as dt

from pyspark.sql import types as T

READING_ROW = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("site_id", T.IntegerType()),
    T.StructField("measurement_time", T.TimestampNTZType()),
    T.StructField("modified_time", T.TimestampNTZType()),
    T.StructField("vehicle_flow_rate", T.IntegerType()),
    T.StructField("data_quality", T.StringType()),
    T.StructField("specific_lane", T.StringType()),
])


def ts(h, m=0, s=0, day=1):
    return dt.datetime(2024, 1, day) + dt.timedelta(hours=h, minutes=m, seconds=s)


def readings_df(spark, rows):
    """rows: (event_id, site, hour-or-datetime, modified, flow[, quality[, lane]])"""
    out = []
    for r in rows:
        r = list(r) + [None] * (7 - len(r))
        if isinstance(r[2], int):
            r[2] = ts(r[2])
        if isinstance(r[3], int):
            r[3] = ts(r[3], 30)
        if r[5] is None:
            r[5] = "good"
        if r[6] is None:
            r[6] = "lane1"
        out.append(tuple(r))
    return spark.createDataFrame(out, READING_ROW)
