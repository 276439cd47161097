"""sitecast: sensor time-series ingestion, history upsert, statistics and
forecasting expressed as Spark DataFrame plans and Structured Streaming jobs.

Every batch operator is ``f(df, ...) -> DataFrame`` and lazy; the only eager
steps are writes, explicit pivot value lists and the ``pyspark.ml`` fit.
"""

from sitecast.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
