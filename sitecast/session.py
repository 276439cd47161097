"""Session construction and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE is what turns a sort-merge join into a
# broadcast join only after the small side's real size has been measured, and
# what splits skewed join partitions at runtime.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "sitecast",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, taken from ``spark.checkpoint.dir``.

    Only when the session names none (unit tests, a laptop) do we create a
    private one and register it as the checkpoint dir as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster: "
                               "stream checkpoints, staging paths and lineage cuts live there")
        root = tempfile.mkdtemp(prefix="sitecast-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A fresh path under the shared folder; never a machine-local temp dir
    unless the session itself points there."""
    root = shared_root(spark)
    suffix = f"-{uuid.uuid4().hex[:12]}" if unique else ""
    return f"{root}/sitecast/{name}{suffix}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem, so it works on any
    cluster store, not only a local disk."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if there is no such folder."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def move_path(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")


def require_utc(spark: SparkSession) -> None:
    """Wall-clock times are UTC throughout; another session zone would shift
    them on the way from text."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def cut_lineage(df):
    """Reliable checkpoint into the shared folder (never a local one): the
    plan runs once, later jobs read the written data, and the data survives
    the loss of the executors that computed it."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
