"""Line deduplication: lines that many documents share go, but for one copy.

Every text is split at line feeds. A line's key is the line without the ASCII
white space at its ends and with A-Z lowered. The long keys are exploded and
hashed (128 bits), the documents of each hash are counted, and a key held by
``min_docs`` documents or more loses its lines in all of them except the largest
doc_id that holds it. The other lines are put together again by position.

Only hashes and positions are shuffled until the texts meet their lists of
dropped positions. A line that a third of the corpus holds stays harmless: its
documents are counted in two steps with partial sums, and the hashes that hold
1/``HEAVY_SHARE`` of all dropped rows or more, ``HEAVY_SHARE`` at most, are
broadcast, so that no shuffle gathers the rows of one of them.

Defined results: a null or empty text is one empty line; rows with the same
doc_id count as one document; a row without doc_id loses shared lines like any
other but counts for none and keeps none for itself; every row gives one result
row, repeated rows included; extra columns are ignored; a line or text of any
length is taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecast.llm.common import LOWER, UPPER, keyed_text, store

MIN_CHARS = 40
MIN_DOCS = 5
BLANKS = " \t\n\x0b\x0c\r"
#: Hashes that hold at least this share of the rows, so at most as many.
HEAVY_SHARE = 4096


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _row_id(key: str, text: str) -> list[Column]:
    """128 bits that tell rows apart by doc_id and text; equal rows share them
    and have equal results."""
    tagged = F.coalesce(F.col(key).cast("string"), F.lit("none"))
    return [F.xxhash64(tagged, F.col(text)).alias("r1"), F.xxhash64(F.lit(1), F.col(text), tagged).alias("r2")]


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """r1, r2, key, pos, h1, h2: the lines whose key has ``min_chars`` code
    points or more, hashed."""
    # a line shorter than the bound cannot have a longer key: no work for it
    lines = docs.select(key, *_row_id(key, text), F.posexplode(_lines(F.col(text))).alias("pos", "line"))
    keys = lines.where(F.length("line") >= min_chars).select("r1", "r2", key, "pos", line_key(F.col("line")).alias("k"))
    return keys.where(F.length("k") >= min_chars).select(
        "r1", "r2", key, "pos", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(1), "k").alias("h2"))


def shared_keys(lines: DataFrame, min_docs: int = MIN_DOCS, key: str = "doc_id") -> DataFrame:
    """h1, h2, n_docs, keeper: the keys in ``min_docs`` documents or more and
    the largest doc_id that holds each."""
    held = lines.where(F.col(key).isNotNull()).groupBy("h1", "h2", key).agg(F.lit(1).alias("one"))
    return (held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max(key).alias("keeper"))
            .where(F.col("n_docs") >= min_docs))


def dropped_positions(lines: DataFrame, shared: DataFrame, key: str = "doc_id") -> DataFrame:
    """r1, r2, gone: the sorted positions that each row loses."""
    total = shared.agg(F.sum("n_docs")).first()[0] or 0
    is_heavy = F.col("n_docs") * HEAVY_SHARE >= total
    heavy = shared.where(is_heavy).select("h1", "h2", F.col("keeper").alias("heavy_keeper"))
    light = shared.where(~is_heavy).select("h1", "h2", "keeper")
    marked = lines.join(F.broadcast(heavy), ["h1", "h2"], "left")  # HEAVY_SHARE rows at most
    lost = [marked.where(~F.col(key).eqNullSafe(F.col("heavy_keeper")) & F.col("heavy_keeper").isNotNull()),
            marked.where(F.col("heavy_keeper").isNull()).join(light, ["h1", "h2"])
            .where(~F.col(key).eqNullSafe(F.col("keeper")))]
    rows = lost[0].select("r1", "r2", "pos").unionByName(lost[1].select("r1", "r2", "pos"))
    # collect_set: equal rows name the same positions
    return rows.groupBy("r1", "r2").agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def _without(lines: Column, gone: Column) -> Column:
    """The lines between the dropped positions, in order. One slice for each
    gap, so the work follows the lines and not lines times drops."""
    n = F.size(gone)
    first = lambda i: F.when(i == 0, 0).otherwise(F.get(gone, i - 1) + 1)
    after = lambda i: F.when(i == n, F.size(lines)).otherwise(F.get(gone, i))
    return F.flatten(F.transform(F.sequence(F.lit(0), n), lambda i: F.slice(lines, first(i) + 1, after(i) - first(i))))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text (the kept lines joined by line feeds), n_lines, n_dropped."""
    rows = keyed_text(docs, key, text)
    lines = store(long_lines(rows, min_chars, key, text), "long-lines")
    shared = store(shared_keys(lines, min_docs, key), "shared-lines")
    gone = dropped_positions(lines, shared, key)
    met = rows.select(key, text, *_row_id(key, text)).join(gone, ["r1", "r2"], "left")
    parts = met.select(key, text, "gone", _lines(F.col(text)).alias("lines"))
    kept = F.when(F.col("gone").isNull(), F.col(text)).otherwise(
        F.array_join(_without(F.col("lines"), F.col("gone")), "\n"))
    return parts.select(key, kept.alias(text), F.size("lines").cast("long").alias("n_lines"),
                        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
