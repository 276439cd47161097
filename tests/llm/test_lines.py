"""op13: line deduplication against a plain Python version."""

import random

import pytest
from pyspark.sql import functions as F

from sitecast.llm import line_dedup as L
from sitecast.llm.common import LOWER, UPPER

CASE = str.maketrans(UPPER, LOWER)
BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars, min_docs):
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            k = line.strip(BLANKS).translate(CASE)
            if len(k) >= min_chars and i is not None:
                held.setdefault(k, set()).add(i)
    shared = {k: max(ids) for k, ids in held.items() if len(ids) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if shared.get(x.strip(BLANKS).translate(CASE), i) == i
                and (i is not None or x.strip(BLANKS).translate(CASE) not in shared)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def run(spark, rows, **bounds):
    docs = spark.createDataFrame([(*r, "clash", 7) for r in rows], "doc_id long, text string, line string, gone int")
    out = L.dedup_lines(docs, **bounds)
    assert out.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("heavy_share", [L.HEAVY_SHARE, 2, 1])
def test_random_texts(spark, monkeypatch, heavy_share):
    monkeypatch.setattr(L, "HEAVY_SHARE", heavy_share)
    rng = random.Random(heavy_share)
    lines = ["", " ", "ab", "AB cd", "\tab CD \r", "abcé", "ÄBC", "äbc", "long line 1", "Long Line 1 ", "x y z", " abc"]
    rows = [(rng.choice([None, *range(9)]), rng.choice([None, "", "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 9)))]))
            for _ in range(60)]
    assert run(spark, rows, min_chars=3, min_docs=4) == brute(rows, 3, 4)


def test_awkward_rows(spark, docs, no_docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in L.dedup_lines(docs, 3, 2).collect()), key=str)
    assert got == brute(rows, 3, 2)
    assert L.dedup_lines(no_docs).count() == 0


def test_a_line_of_a_third_of_all_rows_and_a_long_text(spark):
    hot, other = "h" * 45, "o" * 50
    rows = [(i, f"{hot}\nown {i}\n{other if i % 50 == 0 else 'x'}") for i in range(300)]
    rows += [(1000, "\n".join([hot, "y" * 60] * 20_000)), (5, "equal rows"), (5, "equal rows")]
    assert run(spark, rows) == brute(rows, L.MIN_CHARS, L.MIN_DOCS)


def test_counting_does_not_gather_a_line(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("z" * 64).alias("text"))
    lines = L.long_lines(docs)
    plan = L.shared_keys(lines)._jdf.queryExecution().executedPlan().toString()
    # documents are told apart by (hash, doc_id) first, then counted with partial sums
    assert "partial_count" in plan and "partial_max" in plan
    assert "collect" not in plan and "Window" not in plan
