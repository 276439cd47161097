"""As-of join, interval joins, sessions, trailing frames, subtotals, sketches,
change feeds and SQL functions against plain Python: nulls, ties, repeated rows,
empty tables, hot keys, any bucket width, and the shape of the plans."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sitecast.operators import summaries as S
from sitecast.operators import temporal as T
from sitecast.plans import functions
from sitecast.plans.temporal import QUERIES
from tests.conftest import SMOKE
from tests.test_plans import global_windows, plan

T0 = dt.datetime(2024, 1, 1)
MIN = 60 * T.SECOND
SCHEMA = "k int, t timestamp_ntz, id long, v int"


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def rows_of(rng, n, keys=3, span=400):
    """Irregular times with ties, null keys, times and values, one hot key."""
    return [(rng.choice([None, 1, 1, 1, *range(2, keys + 1)]), at(rng.choice([None, *[rng.randrange(-span, span)] * 9])), i,
             rng.choice([None, 1, 2, 3])) for i in range(n)]


def asof(left, right, direction="backward", tolerance=None, lag=0):
    out = []
    for k, t, i, v in left:
        best = None
        if k is not None and t is not None:
            moved = t - dt.timedelta(microseconds=lag)
            sign = 1 if direction == "backward" else -1
            near = [(sign * (rt - moved), rid, rv) for rk, rt, rid, rv in right
                    if rk == k and rt is not None and sign * (rt - moved) <= dt.timedelta(0)]
            if near:
                best = max(near, key=lambda x: x[:2])
                if tolerance is not None and -best[0] > dt.timedelta(microseconds=tolerance):
                    best = None
        out.append((k, t, i, v, *(best[1:] if best else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket", [1, 7 * MIN, T.DAY, 400 * T.DAY])
@pytest.mark.parametrize("direction, tolerance, lag", [("backward", None, 0), ("forward", 30 * MIN, 0), ("backward", 90 * MIN, 61 * MIN)])
def test_asof_join(spark, bucket, direction, tolerance, lag):
    rng = random.Random(bucket)
    left, right = rows_of(rng, 120), rows_of(rng, 90)
    out = T.asof_join(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["k"], "t", "t",
                      {"r_id": "id", "r_v": "v"}, ["id"], direction=direction, tolerance=tolerance, lag=lag, bucket=bucket)
    assert out.columns == ["k", "t", "id", "v", "r_id", "r_v"]
    assert sorted(map(tuple, out.collect()), key=str) == asof(left, right, direction, tolerance, lag)


def test_asof_join_edges(spark):
    left = spark.createDataFrame(rows_of(random.Random(1), 20), SCHEMA)
    none = left.limit(0)
    values = {"r_id": "id"}
    assert T.asof_join(none, left, ["k"], "t", "t", values).count() == 0
    alone = T.asof_join(left, none, ["k"], "t", "t", values)
    assert alone.count() == 20 and alone.where("r_id is not null").count() == 0
    with pytest.raises(ValueError, match="names of both sides"):
        T.asof_join(left, left, ["k"], "t", "t", {"id": "id"})
    with pytest.raises(ValueError, match="direction"):
        T.asof_join(left, left, ["k"], "t", "t", values, direction="nearest")


def test_asof_join_spreads_a_hot_key(spark):
    """No exchange is by the key alone but the one of the bucket summaries."""
    df = spark.range(2000).selectExpr("1 AS k", "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,id) AS t", "id", "1 AS v")
    out = T.asof_join(df, df, ["k"], "t", "t", {"r": "id"}, ["id"], bucket=60 * MIN)
    text = plan(out)
    by_key = [x for x in text.splitlines() if "Exchange hashpartitioning(k#" in x and "_b#" not in x]
    assert by_key and not global_windows(text) and "NestedLoop" not in text
    tops = out.withColumn("same", F.col("r") == F.col("id"))
    assert tops.where("same").count() == 2000


def spans_of(rng, n):
    out = []
    for i in range(n):
        a = rng.randrange(-400, 400)
        out.append((rng.choice([None, 1, 1, 2]), at(rng.choice([None, a, a, a, a])),
                    at(rng.choice([None, a, a - 5, a + 1, a + 7, a + 60, a + 60, a + 5000])), i))
    return out


@pytest.mark.parametrize("width", [1000, 10 * MIN, T.HOUR, 100 * T.DAY])
def test_interval_joins(spark, width):
    rng = random.Random(3)
    points, spans = rows_of(rng, 100), spans_of(rng, 60)
    p = spark.createDataFrame(points, SCHEMA)
    s = spark.createDataFrame(spans, "k int, lo timestamp_ntz, hi timestamp_ntz, span long")
    within = lambda t, lo, hi: None not in (t, lo, hi) and lo <= t < hi
    want = sorted((i, j) for k, t, i, _ in points for q, lo, hi, j in spans if k is not None and k == q and within(t, lo, hi))
    got = T.interval_join(p, s, ["k"], "t", "lo", "hi", width if width > 1000 else MIN)
    assert sorted((r.id, r.span) for r in got.collect()) == want
    b = s.selectExpr("k", "lo AS lo2", "hi AS hi2", "span AS span2")
    both = [(i, j) for k, a0, a1, i in spans for q, b0, b1, j in spans
            if k is not None and k == q and None not in (a0, a1, b0, b1) and a0 < a1 and b0 < b1 and a0 < b1 and b0 < a1]
    got = T.overlap_join(s, b, ["k"], ("lo", "hi"), ("lo2", "hi2"), width if width > 1000 else MIN)
    assert sorted((r.span, r.span2) for r in got.collect()) == sorted(both)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    assert T.interval_join(p.limit(0), s, ["k"], "t", "lo", "hi").count() == 0
    assert T.interval_join(p, s.limit(0), ["k"], "t", "lo", "hi").count() == 0
    assert T.overlap_join(s.limit(0), b, ["k"], ("lo", "hi"), ("lo2", "hi2")).count() == 0
    with pytest.raises(ValueError, match="names of both sides"):
        T.overlap_join(s, s, ["k"], ("lo", "hi"), ("lo", "hi"))


def test_a_long_span_makes_few_copies(spark):
    s = spark.createDataFrame([(1, at(0), at(60 * 24 * 3650), 1)], "k int, lo timestamp_ntz, hi timestamp_ntz, span long")
    levelled = T._levelled(s, ["k"], "lo", "hi", T.HOUR)
    assert len(levelled.select(T._bins(F.col("_level"), T.HOUR)).first()[0]) <= 3


@pytest.mark.parametrize("bucket", [7 * MIN, T.HOUR, T.DAY, 400 * T.DAY])
def test_sessions_equal_spark_session_windows(spark, bucket):
    rng = random.Random(bucket)
    rows = rows_of(rng, 150) + [(9, at(m), 900 + m, 1) for m in (0, 10, 20, 31, 41)]   # the gap exactly, and a minute more
    df = spark.createDataFrame(rows, SCHEMA)
    measures = {"n": ("count", "id"), "total": ("sum", "v"), "low": ("min", "v"), "top": ("max", "v")}
    got = T.sessions(df, ["k"], "t", 10 * MIN, measures, bucket)
    want = df.where("k is not null and t is not null").groupBy("k", F.session_window("t", "10 minutes")).agg(
        F.count("id").alias("n"), F.sum("v").alias("total"), F.min("v").alias("low"), F.max("v").alias("top")).select(
        "k", "session_window.start", "session_window.end", "n", "total", "low", "top")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert T.sessions(df.limit(0), ["k"], "t", MIN, measures).count() == 0


@pytest.mark.parametrize("bucket", [MIN, T.HOUR, 400 * T.DAY])
def test_trailing_frames_and_lags(spark, bucket):
    rng = random.Random(5)
    rows = rows_of(rng, 150)
    df = spark.createDataFrame(rows, SCHEMA)
    got = T.trailing(df, ["k"], "t", 45 * MIN, {"n": F.count(F.lit(1)), "total": F.sum("v")}, bucket)
    want = []
    for k, t, i, v in rows:
        if k is None or t is None:
            want.append((k, t, i, v, None, None))
            continue
        frame = [x for q, u, _, x in rows if q == k and u is not None and t - dt.timedelta(minutes=45) <= u <= t]
        known = [x for x in frame if x is not None]
        want.append((k, t, i, v, len(frame), sum(known) if known else None))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    before = T.value_at_lag(df, ["k"], "t", "v", 30 * MIN, ["id"], bucket=bucket)
    known = [r for r in rows if r[3] is not None]
    assert sorted(map(tuple, before.collect()), key=str) == sorted((r[:4] + r[5:] for r in asof(rows, known, lag=30 * MIN)), key=str)


def test_subtotals_are_told_from_real_nulls(spark):
    df = spark.createDataFrame([(None, "x", 1), (None, "x", 2), ("a", "x", 2), ("a", None, 2)], "p string, q string, v int")
    out = S.subtotals(df, S.cube_sets(["p", "q"]), ["p", "q"], {"n": F.count(F.lit(1)), "d": F.count_distinct("v")})
    got = {(r.p, r.q, r.p_all, r.q_all): (r.n, r.d) for r in out.collect()}
    assert got[(None, "x", False, False)] == (2, 2) and got[(None, "x", True, False)] == (3, 2)
    assert got[(None, None, True, True)] == (4, 2) and got[("a", None, False, False)] == (1, 1)
    assert got[("a", None, False, True)] == (2, 1) and len(got) == out.count() == 8
    rolled = S.subtotals(df, S.rollup_sets(["p", "q"]), ["p", "q"], {"n": F.count(F.lit(1))})
    assert rolled.count() == 6 and "Expand" in plan(rolled) and "partial_count" in plan(rolled)
    assert S.subtotals(df.limit(0), S.rollup_sets(["p"]), ["p"], {"n": F.count(F.lit(1))}).count() <= 1


def test_sketches_merge_like_one(spark, tmp_path):
    df = spark.range(60_000).selectExpr("id % 30 AS day", "id % 20011 AS site", "id AS v")
    days = S.day_sketches(df, F.col("day"), "site", "v")
    days.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 30
    r = S.merge_sketches(stored).select("n", S.distinct_estimate().alias("d"), S.quantile_estimate(0.25).alias("q"),
                                        F.length("distinct_state").alias("size")).first()
    assert r.n == 60_000 and abs(r.d - 20011) <= 20011 * 4 * 1.04 / 2 ** (S.LG_K / 2)
    assert abs(r.q - 15_000) <= 60_000 * 0.0333 and r["size"] < 1 << 13
    nulls = spark.createDataFrame([(1, None, None)], "day int, site long, v long")
    empty = S.merge_sketches(S.day_sketches(nulls, F.col("day"), "site", "v"))
    assert empty.select(S.distinct_estimate().alias("d")).first().d == 0


def test_change_feed_turns_one_state_into_the_other(spark):
    rng = random.Random(8)
    make = lambda: [(rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "x", "y"])) for _ in range(25)]
    a, b = make() + [(9, "gone")], make() + [(10, "new")]
    before, after = (spark.createDataFrame(x, "k int, v string") for x in (a, b))
    state = Counter(a)
    for r in S.change_feed(before, after, ["k"]).collect():
        state[(r.k, r.v)] += 1 if r.kind in ("inserted", "changed_to") else -1
        there = {x[0] for x in (a if r.kind in ("inserted", "changed_to") else b)}
        assert (r.k in there) == (r.kind in ("changed_to", "changed_from"))
    assert +state == Counter(b) and min(state.values()) >= 0
    assert Counter(map(tuple, S.unchanged(before, after).collect())) == Counter(a) & Counter(b)
    assert S.change_feed(before, before, ["k"]).count() == 0


def test_sql_functions_push_filters_down(spark):
    assert functions.register(spark, SMOKE) == list(functions.FUNCTIONS)
    p = plan(spark.sql("""SELECT event_id FROM readings_between(TIMESTAMP_NTZ'2024-01-10', TIMESTAMP_NTZ'2024-01-12')
                          WHERE event_id > 5"""))
    assert "GreaterThanOrEqual(ts,2024-01-10" in p and "(event_id#" in p
    scan = next(x for x in p.splitlines() if "FileScan parquet" in x)
    assert "props" not in scan and "value" not in scan
    n = spark.sql("SELECT * FROM latest_readings(2) WHERE site_id = 7")
    assert n.count() == 2 and "WindowGroupLimit" in plan(n)
    assert spark.sql("SELECT * FROM slot_statistics(10000)").count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_join_by_equality(spark, name):
    p = plan(QUERIES[name](spark, SMOKE))
    assert "CartesianProduct" not in p and "NestedLoop" not in p and not global_windows(p)
