"""Shared helpers: table access, scratch tables, vectorised word hashing."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import sitecast
from sitecast.session import delete_path, scratch_path

#: A word of the contracts: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows to an Arrow batch; texts make wide rows.
ARROW_ROWS = 1000

#: Broadcast bound of ``among``: ids of 8 bytes.
MAX_IDS = 1 << 21

#: Bytes of text handled at a time inside a task.
CHUNK_BYTES = 1 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    sc = spark.sparkContext
    if getattr(sc, "_sitecast_shipped", False):
        return
    top = Path(sitecast.__file__).parent
    path = f"{tempfile.mkdtemp(prefix='sitecast-')}/sitecast-package.zip"  # on the driver, which serves it
    atexit.register(shutil.rmtree, str(Path(path).parent), ignore_errors=True)
    with zipfile.ZipFile(path, "w") as z:
        for f in top.rglob("*.py"):
            z.write(f, f"{top.name}/{f.relative_to(top)}")
    sc.addPyFile(path)
    sc._sitecast_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(docs: DataFrame, key: str = "doc_id", text: str = "text", *more: Column) -> DataFrame:
    """The columns an operator works on; a null text is the empty text."""
    ship(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias(key),
                       F.coalesce(F.col(text), F.lit("")).alias(text), *more)


def store(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write an intermediate table to the shared folder and read it back. The
    plan runs once, and the result survives a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with arrow_rows(spark, ARROW_ROWS):
        df.write.option("compression", codec).parquet(path)
    release(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner see what is no longer referenced, so that the shuffle
    files of finished steps go before the next step writes its own."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Fewer rows to an Arrow batch while steps with very wide rows run."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def among(df: DataFrame, ids: DataFrame, key: str, keep: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``key`` is (not) in the one column of ``ids``. Up to
    MAX_IDS distinct ids are broadcast as a sorted array, so that wide rows need
    no shuffle; beyond it, a semi (anti) join does the same."""
    spark = df.sparkSession
    ids = ids.toDF(key).where(F.col(key).isNotNull()).distinct()
    n = ids.limit(MAX_IDS + 1).count()
    if n > MAX_IDS:
        return df.join(ids, key, "left_semi" if keep else "left_anti")
    ship(spark)
    wanted = np.sort(np.array([r[0] for r in ids.collect()], np.int64))
    shared = spark.sparkContext.broadcast(wanted)
    place = df.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = shared.value
        for batch in batches:
            column = batch.column(place)
            values = column.fill_null(0).to_numpy()
            at = np.minimum(np.searchsorted(have, values), max(0, len(have) - 1))
            hit = (have[at] == values if len(have) else np.zeros(len(values), bool)) & ~column.is_null().to_numpy(False)
            yield batch.filter(pa.array(hit if keep else ~hit))

    return df.mapInArrow(run, df.schema)


def bounded_sample(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """The ``n`` rows that come first in the hash order of ``keys``, the same ones
    in any file or partition layout. Rows whose hash is beyond four times the
    share of ``n`` are thinned out where they are read, so few rows are sorted
    however large the table; a key that repeats may need a larger share."""
    total = rows.count()
    share, first = 4.0 * n / max(1, total), rows
    while share < 1:
        first = rows.where(F.xxhash64(*keys) < F.lit(int(share * 2**64) - 2**63))
        if first.limit(n).count() == n:
            break
        share, first = 16 * share, rows
    return first.orderBy(F.xxhash64(*keys), *keys).limit(n)


def drop_stored(*tables: DataFrame) -> None:
    """Remove intermediate tables that nothing reads any more."""
    for t in tables:
        delete_path(t.sparkSession, t.scratch)


def sub_batches(batches: Iterator[pa.RecordBatch], text: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``limit`` bytes of text (one row at
    least), with the UTF-8 bytes of the slice's texts and the n+1 bounds."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        n = len(col)
        if not n:
            continue
        offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + n + 1]
        raw = col.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < n:
            hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
            hi = min(n, max(hi, lo + 1))
            yield batch.slice(lo, hi - lo), data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            lo = hi


# ---- vectorised words ---------------------------------------------------

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.RandomState(7).randint(0, 2**63 - 1, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i < n."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        up = np.full(size, _P, np.uint64)
        down = np.full(size, pow(_P, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _powers[0], _powers[1]


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (xor, shift, multiply)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each byte span, from one running sum."""
    up, down = _power_tables(len(data) + 1)
    acc = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=acc[1:])
    return (acc[ends] - acc[starts]) * down[starts]


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the A-Z-lowered words of every text in ``data`` and the
    n+1 bounds of each text's words. Words never span two texts."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    inside = ~_IS_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    firsts = bounds[:-1][bounds[:-1] < bounds[1:]]
    opens[firsts] = inside[firsts]
    lasts = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    closes[lasts] = inside[lasts]
    s, e = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    h = rolling_hashes(_LOWER[data], s, e)
    return mix64(h + (e - s).astype(np.uint64)), np.searchsorted(s, bounds)
