"""Versioned forecast files and the loss-history sink.

Each forecast cycle writes one Parquet dataset whose name carries the
version (``<prefix>_model_<n>_prediction.parquet``). Readers scan all of
them with one glob, take the version from the hidden ``_metadata`` file path
and keep the highest version per key. A file that cannot be read is skipped by
Spark, but never silently: the files that gave rows are set against the files
listed, and what is missing is logged and returned by ``damaged_files``.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitecast.functions.columns import version_from_name
from sitecast.session import child_names, path_exists

log = logging.getLogger(__name__)

# Fixed value: the forecast file naming of the reference.
FILE_PREFIX = "traffic_data_to_model"

FORECAST_SCHEMA = T.StructType([
    T.StructField("site_id", T.IntegerType()),
    T.StructField("measurement_time", T.TimestampNTZType()),
    T.StructField("vehicle_flow_rate", T.DoubleType()),
    T.StructField("forecast_type", T.StringType()),
])


def version_path(root: str, version: int) -> str:
    return f"{root}/{FILE_PREFIX}_{version}_prediction.parquet"


def write_version(df: DataFrame, root: str, version: int) -> str:
    """One dataset per cycle; rewriting a version is idempotent."""
    path = version_path(root, version)
    (df.select(*[f.name for f in FORECAST_SCHEMA.fields])
     .sortWithinPartitions("site_id", "measurement_time", "forecast_type")
     .write.mode("overwrite").parquet(path))
    return path


def _pattern(root: str) -> str:
    return f"{root}/{FILE_PREFIX}_*_prediction.parquet"


def has_versions(spark: SparkSession, root: str) -> bool:
    return any(n.startswith(f"{FILE_PREFIX}_") and n.endswith("_prediction.parquet")
               for n in child_names(spark, root))


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of all part files; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(_pattern(root))
    return files.select("path", "length")


def _readable(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(FORECAST_SCHEMA).option("ignoreCorruptFiles", "true").parquet(_pattern(root))


#: A Parquet file without rows is its schema and footer; a longer file that
#: gives no row is damaged, a shorter one is looked into.
EMPTY_BYTES = 1 << 20


def damaged_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, version, length) of the part files that no row can be read from
    although they are not empty tables, such as those of a writer that was cut
    off. Files with rows are told by their footers (a count that needs no column);
    only small files without rows are opened to tell an empty table."""
    none = spark.createDataFrame([], "path string, version int, length long")
    if not has_versions(spark, root):
        return none
    name = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    files = _readable(spark, root).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    seen = files.select(name("file").alias("seen"))
    listed = _listed(spark, root)
    silent = listed.join(seen, name(F.col("path")) == F.col("seen"), "left_anti")
    small = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(_pattern(root))
             .where(F.col("length") <= EMPTY_BYTES))
    mark = F.expr("X'50415231'")
    whole = (F.substring("content", 1, 4) == mark) & (F.expr("substring(content, -4, 4)") == mark) & (F.col("length") >= 12)
    empty = small.join(silent.select("path"), "path", "left_semi").where(whole).select("path")
    return silent.join(empty, "path", "left_anti").select("path", version_from_name("path").alias("version"), "length")


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """Every version file matching the pattern, with its version
    number parsed from the path (-1 when not numeric). A fixed schema means no
    footer inference across many files; the number is parsed once a file, not
    for every row. Without any version the result is empty; files that cannot be read
    are left out and logged (the first ones by name)."""
    if not has_versions(spark, root):
        return spark.createDataFrame([], FORECAST_SCHEMA).withColumn("version", F.lit(0))
    bad = [r.path for r in damaged_files(spark, root).orderBy("path").limit(20).collect()]
    if bad:
        log.warning("left out %s%d damaged forecast files: %s", "at least " * (len(bad) == 20), len(bad), bad)
    rows = _readable(spark, root).withColumn("_file", F.col("_metadata.file_path"))
    files = rows.select("_file").distinct().withColumn("version", version_from_name("_file"))
    return rows.join(F.broadcast(files), "_file").drop("_file")


def newest_listed(spark: SparkSession, root: str) -> DataFrame:
    """The highest number among the names of the version files (one row;
    null without any). Names only, no file is opened."""
    names = [(n,) for n in child_names(spark, root) if n.startswith(f"{FILE_PREFIX}_") and n.endswith("_prediction.parquet")]
    return spark.createDataFrame(names, "name string").agg(F.max(version_from_name("name")).alias("version"))


def newest_version(versions: DataFrame) -> DataFrame:
    """The highest version present (one row)."""
    return versions.agg(F.max("version").alias("version"))


LOSS_SCHEMA = T.StructType([
    T.StructField("train_loss", T.DoubleType()),
    T.StructField("eval_loss", T.DoubleType()),
    T.StructField("measurement_time", T.TimestampNTZType()),
])


def append_loss(loss: DataFrame, root: str) -> None:
    """One row per cycle, under the day of the cycle. A cycle that is
    written again replaces its own row, so no cycle occurs twice."""
    (loss.select(*[f.name for f in LOSS_SCHEMA.fields]).withColumn("cycle", F.to_date("measurement_time"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("cycle").parquet(f"{root}/loss"))


def read_loss(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, f"{root}/loss"):
        return spark.createDataFrame([], LOSS_SCHEMA)
    return spark.read.schema(LOSS_SCHEMA).parquet(f"{root}/loss").select(*LOSS_SCHEMA.names)


def export_single_file(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One output file, for small exports only (a chart extract, a
    report). ``coalesce(1)`` funnels everything through one task, so the
    pipeline's own tables are written partitioned instead."""
    df.coalesce(1).write.mode("overwrite").format(fmt).save(path)
