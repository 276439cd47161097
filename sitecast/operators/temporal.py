"""Joins and windows over irregular times: as-of join, interval joins, sessions,
trailing frames, and the value at a lag in time.

A key is never one task. Time is cut into buckets and the work of a key is
shuffled by (key, bucket); what crosses a bucket's edge is carried over in a
summary with a row or two for each bucket, so a key with a third of all rows is
spread over the buckets of its time range. Bucket widths are parameters; results
never depend on them.

Rows whose key or time is null match nothing: as the left side of an as-of join
or a frame they stay, with nulls; elsewhere they are left out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECOND = 1_000_000
HOUR = 3600 * SECOND
DAY = 24 * HOUR


def micros(time: Column) -> Column:
    """Microseconds since 1970 of a wall-clock time (the session zone is UTC)."""
    return F.unix_micros(time.cast("timestamp"))


def _all_set(*cols: str) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


# -- as-of join -----------------------------------------------------------------

def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str,
              values: Mapping[str, str], right_order: Sequence[str] = (), direction: str = "backward",
              tolerance: int | None = None, lag: int = 0, bucket: int = DAY) -> DataFrame:
    """Every left row with the right row of the same key whose time is the
    newest at or before the left time (``direction="forward"``: the oldest at or
    after it). ``lag`` moves the left time back by so many microseconds first;
    a match further away than ``tolerance`` microseconds counts as none.

    ``values`` maps output names to right columns. Among right rows of one time
    the greatest ``right_order`` tuple wins, so a total order makes the result
    unique. Equal times match.

    Both sides are sorted together within (key, bucket), where the last right
    row seen so far is the match; a left row with none in its bucket takes the
    last right row of the buckets before, from a table of one row for each key
    and bucket.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction must be backward or forward, not {direction}")
    if clash := set(values) & set(left.columns):
        raise ValueError(f"names of both sides: {sorted(clash)}")
    on = list(on)
    sign = 1 if direction == "backward" else -1
    orders = [f"_o{i}" for i in range(len(right_order))]
    right = right.where(_all_set(*on, right_time))
    r = right.select(*on, (micros(F.col(right_time)) * sign).alias("_t"), F.lit(0).alias("_side"),
                     *[F.col(c).alias(o) for c, o in zip(right_order, orders)],
                     F.struct(micros(F.col(right_time)).alias("_at"), *[F.col(c).alias(n) for n, c in values.items()]).alias("_r"))
    whole = _all_set(*on, left_time)
    l = left.where(whole).select(*on, ((micros(F.col(left_time)) - lag) * sign).alias("_t"), F.lit(1).alias("_side"),
                                 F.struct(*left.columns).alias("_l"))
    rows = l.unionByName(r, allowMissingColumns=True).withColumn("_b", F.floor(F.col("_t") / bucket))
    seen = Window.partitionBy(*on, "_b").orderBy("_t", "_side", *orders).rowsBetween(Window.unboundedPreceding, 0)
    matched = rows.withColumn("_m", F.last("_r", ignorenulls=True).over(seen)).where(F.col("_side") == 1)
    newest = rows.groupBy(*on, "_b").agg(
        F.max_by("_r", F.when(F.col("_side") == 0, F.struct("_t", *orders))).alias("_newest"))
    before = Window.partitionBy(*on).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.select(*on, "_b", F.last("_newest", ignorenulls=True).over(before).alias("_carried"))
    hit = F.coalesce("_m", "_carried")
    if tolerance is not None:
        hit = F.when(F.abs(hit["_at"] * sign - F.col("_t")) <= tolerance, hit)
    found = matched.join(carried, [*on, "_b"], "left").select("_l", hit.alias("_hit")).select(
        "_l.*", *[F.col("_hit")[n].alias(n) for n in values])
    types = {f.name: f.dataType for f in found.schema.fields}
    without = left.where(~whole).select(*left.columns, *[F.lit(None).cast(types[n]).alias(n) for n in values])
    return found.unionByName(without)


# -- interval joins -------------------------------------------------------------

def _levels(spans: DataFrame) -> list[int]:
    """The levels in use: at most one for each doubling of a length."""
    return sorted(r[0] for r in spans.select("_level").distinct().collect())


def _levelled(spans: DataFrame, on: Sequence[str], start: str, end: str, width: int) -> DataFrame:
    """Spans [start, end) in microseconds with their level: a bin of level k is
    ``width * 2^k`` wide, and a span of that level covers three bins at most."""
    s = spans.where(_all_set(*on, start, end)).withColumn("_s", micros(F.col(start))).withColumn("_e", micros(F.col(end)))
    s = s.where(F.col("_s") < F.col("_e"))
    ratio = (F.col("_e") - F.col("_s")) / F.lit(float(width))
    return s.withColumn("_level", F.greatest(F.lit(0), F.ceil(F.log2(ratio))).cast("int"))


def _bin(time: Column, level: Column, width: int) -> Column:
    wide = (F.lit(width) * F.pow(F.lit(2.0), level)).cast("long")
    return F.floor(time / wide).cast("long")


def _bins(level: Column, width: int) -> Column:
    return F.sequence(_bin(F.col("_s"), level, width), _bin(F.col("_e") - 1, level, width))


def interval_join(points: DataFrame, spans: DataFrame, on: Sequence[str], time: str, start: str, end: str,
                  width: int = HOUR) -> DataFrame:
    """Every pair of a point and a span of the same key with
    ``start <= time < end``, once. Empty spans hold nothing.

    A span is copied into the bins that it covers, of a width that follows its
    own length, so long spans make no more copies than short ones; a point has
    one bin for each level in use. The join is by equality of key and bin.
    """
    _no_clash(points, spans, on)
    s = _levelled(spans, on, start, end, width)
    levels = _levels(s)
    s = s.withColumn("_bin", F.explode(_bins(F.col("_level"), width)))
    t = micros(F.col(time))
    places = [F.struct(F.lit(k).alias("_level"), _bin(t, F.lit(k), width).alias("_bin")) for k in levels]
    none = F.array().cast("array<struct<_level:int,_bin:bigint>>")
    p = (points.where(_all_set(*on, time)).withColumn("_t", t)
         .withColumn("_at", F.explode(F.array(*places) if places else none)).withColumns(
             {"_level": F.col("_at._level"), "_bin": F.col("_at._bin")}).drop("_at"))
    hit = p.join(s, [*on, "_level", "_bin"]).where((F.col("_t") >= F.col("_s")) & (F.col("_t") < F.col("_e")))
    return hit.drop("_level", "_bin", "_t", "_s", "_e")


def overlap_join(a: DataFrame, b: DataFrame, on: Sequence[str], a_span: tuple[str, str], b_span: tuple[str, str],
                 width: int = HOUR) -> DataFrame:
    """Every pair of spans of the same key that overlap, once. Spans are
    half-open and meet in the bin where the later one starts, on the level of
    the longer one."""
    _no_clash(a, b, on)
    left, right = (_levelled(x, on, *span, width) for x, span in ((a, a_span), (b, b_span)))
    levels = _levels(left.select("_level").unionByName(right.select("_level")))

    def spread(x: DataFrame, tag: str) -> DataFrame:
        at = [F.when(F.col("_level") <= k, _tagged(_bins(F.lit(k), width), k)) for k in levels]
        none = F.array().cast("array<struct<_k:int,_bin:bigint>>")
        places = F.flatten(F.filter(F.array(*at), lambda p: p.isNotNull())) if at else none
        out = x.withColumn("_p", F.explode(places)).withColumns({"_k": F.col("_p._k"), "_bin": F.col("_p._bin")}).drop("_p")
        return out.withColumnsRenamed({c: f"{c}_{tag}" for c in ("_s", "_e", "_level")})

    pairs = spread(left, "a").join(spread(right, "b"), [*on, "_k", "_bin"])
    late = F.greatest("_s_a", "_s_b")
    met = ((late < F.least("_e_a", "_e_b")) & (F.col("_k") == F.greatest("_level_a", "_level_b"))
           & (F.col("_bin") == _bin(late, F.col("_k"), width)))
    return pairs.where(met).drop("_k", "_bin", *[f"{c}_{t}" for c in ("_s", "_e", "_level") for t in "ab"])


def _tagged(bins: Column, level: int) -> Column:
    return F.transform(bins, lambda i: F.struct(F.lit(level).alias("_k"), i.alias("_bin")))


def _no_clash(a: DataFrame, b: DataFrame, on: Sequence[str]) -> None:
    if clash := (set(a.columns) & set(b.columns)) - set(on):
        raise ValueError(f"names of both sides: {sorted(clash)}")


# -- sessions -------------------------------------------------------------------

#: How a measure of a session follows from the measures of its parts.
MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
FIRST = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}


def sessions(df: DataFrame, on: Sequence[str], time: str, gap: int, measures: Mapping[str, tuple[str, str]],
             bucket: int = DAY) -> DataFrame:
    """Activity sessions of each key: rows less than or exactly ``gap`` microseconds
    after the row before belong together. ``session_start`` is the first time,
    ``session_end`` the last time plus the gap, as Spark's ``session_window`` has
    them; ``measures`` maps output names to (count | sum | min | max, column).

    Rows are first gathered into the sessions of one bucket. Only the first and
    last of a bucket can go on in a neighbour, so at most two rows for each key
    and bucket meet per key to be merged; all others are done.
    """
    on = list(on)
    rows = df.where(_all_set(*on, time)).withColumn("_t", micros(F.col(time)))
    rows = rows.withColumn("_b", F.floor(F.col("_t") / bucket))
    near = Window.partitionBy(*on, "_b").orderBy("_t")
    parts = (_numbered(rows, near, F.col("_t"), F.col("_t"), gap)
             .groupBy(*on, "_b", "_n").agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"),
                                           *[FIRST[f](c).alias(name) for name, (f, c) in measures.items()]))
    parts = parts.withColumn("_edge", (F.col("_n") == 1) | (F.col("_n") == F.max("_n").over(Window.partitionBy(*on, "_b"))))
    along = Window.partitionBy(*on).orderBy("_first")
    merged = (_numbered(parts.where("_edge"), along, F.col("_first"), F.col("_last"), gap)
              .groupBy(*on, "_n").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"),
                                      *[MERGES[f](name).alias(name) for name, (f, _) in measures.items()]))
    cols = [*on, "_first", "_last", *measures]
    done = parts.where(~F.col("_edge")).select(*cols).unionByName(merged.select(*cols))
    at = lambda us: F.timestamp_micros(us).cast("timestamp_ntz")
    return done.select(*on, at(F.col("_first")).alias("session_start"), at(F.col("_last") + gap).alias("session_end"), *measures)


def _numbered(rows: DataFrame, order, first: Column, last: Column, gap: int) -> DataFrame:
    opens = F.coalesce(first - F.lag(last).over(order) > gap, F.lit(True))
    return rows.withColumn("_new", opens.cast("int")).withColumn("_n", F.sum("_new").over(
        order.rowsBetween(Window.unboundedPreceding, 0)))


# -- frames over time -----------------------------------------------------------

def trailing(df: DataFrame, on: Sequence[str], time: str, span: int, aggregates: Mapping[str, Column],
             bucket: int = DAY) -> DataFrame:
    """The rows of ``df`` with aggregates over the rows of the same key in the
    ``span`` microseconds up to and with the row's time (a RANGE frame: rows of
    equal time are in each other's frames). Times may be irregular.

    Each bucket gets the rows of the bucket before that its frames reach, so the
    buckets of a key are worked on apart.
    """
    on, width = list(on), max(bucket, span)
    whole = _all_set(*on, time)
    rows = df.where(whole).withColumn("_t", micros(F.col(time)))
    own = F.floor(F.col("_t") / width)
    reach = F.col("_t") + span >= (own + 1) * width
    rows = rows.withColumn("_b", F.explode(F.when(reach, F.array(own, own + 1)).otherwise(F.array(own))))
    frame = Window.partitionBy(*on, "_b").orderBy("_t").rangeBetween(-span, 0)
    out = rows.select(*df.columns, "_b", "_t", *[c.over(frame).alias(n) for n, c in aggregates.items()])
    out = out.where(F.col("_b") == F.floor(F.col("_t") / width)).drop("_b", "_t")
    types = {f.name: f.dataType for f in out.schema.fields}
    return out.unionByName(df.where(~whole).select(*df.columns, *[F.lit(None).cast(types[n]).alias(n) for n in aggregates]))


def value_at_lag(df: DataFrame, on: Sequence[str], time: str, value: str, lag: int, order: Sequence[str] = (),
                 name: str | None = None, bucket: int = DAY) -> DataFrame:
    """Every row with the newest ``value`` that is not null and at least ``lag``
    microseconds older, of the same key."""
    known = df.where(F.col(value).isNotNull()).select(*dict.fromkeys([*on, time, value, *order]))
    return asof_join(df, known, on, time, time, {name or f"{value}_before": value}, order, lag=lag, bucket=bucket)
