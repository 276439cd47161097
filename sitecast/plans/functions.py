"""The operators as SQL: views of the given tables and parameterised table
functions. Each function is one SELECT that Catalyst inlines, so a caller's
filter and column choice still reach the scan.

    spark.sql("SELECT * FROM latest_readings(20) WHERE site_id = 7")
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from sitecast.sources import tables

#: name -> (parameters, body). A body reads the view ``readings`` and functions
#: that stand above it.
FUNCTIONS = {
    "readings_between": ("lo TIMESTAMP_NTZ, hi TIMESTAMP_NTZ", """
        SELECT * FROM readings WHERE modified_time >= readings_between.lo AND modified_time < readings_between.hi"""),
    "deduplicated": ("", """
        SELECT * EXCEPT (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY site_id, measurement_time
                                       ORDER BY modified_time DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
          FROM readings) WHERE rn = 1"""),
    "latest_readings": ("n INT", """
        SELECT site_id, measurement_time, vehicle_flow_rate, rn FROM (
          SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY measurement_time DESC NULLS LAST) AS rn
          FROM deduplicated()) WHERE rn <= latest_readings.n"""),
    "slot_statistics": ("min_readings INT DEFAULT 1", """
        SELECT measurement_time, round(avg(vehicle_flow_rate), 6) AS avg_vehicle_flow_rate,
               round(stddev_samp(vehicle_flow_rate), 6) AS std_vehicle_flow_rate, count(*) AS n_readings
        FROM readings WHERE measurement_time IS NOT NULL GROUP BY measurement_time
        HAVING count(*) >= slot_statistics.min_readings"""),
}


def register(spark: SparkSession, sf_dir: str) -> list[str]:
    """Create the views and functions in the session; returns the functions' names."""
    tables.readings(spark, sf_dir).createOrReplaceTempView("readings")
    tables.sites(spark, sf_dir).createOrReplaceTempView("sites")
    for name, (parameters, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE RETURN {body}")
    return list(FUNCTIONS)
