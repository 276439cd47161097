"""op6: counts and verdicts against brute force."""

import re
from collections import Counter

import pytest

from sitecast.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    tri = Counter(zip(w, w[1:], w[2:]))
    cover = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover))


def test_counts(spark, docs):
    more = [(20, "a b c a b c", "en"), (21, "x x x x", "en"), (22, "l1\nl1\n\n \nl2\r\nl2\nl1", "en"),
            (23, "#a | b $5 <tag> & 10% ***", "de"), (24, "a b a b a", None), (25, "p q r s p q", "es")]
    both = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string"))
    texts = {r.doc_id: r.text for r in both.collect()}
    rows = Q.quality(both).collect()
    assert len(rows) == both.count()
    for r in rows:
        want = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_distance(spark):
    import math
    df = spark.createDataFrame([([1, 0, 3], [2.0, 2.0, 4.0]), ([0, 0, 0], [1.0, 1.0, 1.0]), ([5, 0, 0], [0.0, 7.0, 0.0]),
                                ([2, 4, 6], [1.0, 2.0, 3.0]), (None, [1.0, 1.0, 1.0])], "c array<long>, r array<double>")
    got = [r[0] for r in df.select(Q.js_distance(df.c, df.r)).collect()]
    p, q = [0.25, 0, 0.75], [0.25, 0.25, 0.5]
    kl = lambda a: sum(x * math.log2(2 * x / (x + y)) for x, y in a if x)
    assert got[0] == pytest.approx(math.sqrt((kl(zip(p, q)) + kl(zip(q, p))) / 2))
    assert got[1] is None and got[2] == pytest.approx(1) and got[3] == pytest.approx(0) and got[4] is None


def test_verdicts_on_labelled_rows(spark):
    d = "/root/testdata/sf0.01"
    rows = Q.quality(spark.read.parquet(f"{d}/documents.parquet")).join(
        spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("NOT base_failed").select("kept", "quality").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.25 * len(bad)


def test_stage_keeps_columns_and_empty_tables(spark, docs, no_docs):
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} <= {r.doc_id for r in docs.collect()}
    assert Q.keep_good(no_docs).count() == 0 and Q.quality(no_docs).count() == 0


def test_no_python_in_the_plan(docs):
    plan = Q.judge(Q.measure(docs, "text", "lang", "doc_id"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def test_a_large_odd_source_does_not_move_the_reference(spark):
    """Clean documents of a small language stay although one junk source of that
    language holds most of its rows."""
    import random
    rng = random.Random(6)
    common = Q.COMMON_WORDS["es"]
    other = [f"palabra{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    clean = [(i, " ".join(rng.choice(common if rng.random() < 0.5 else other) for _ in range(150)), "es", f"s{i % 8}")
             for i in range(80)]
    junk = [(1000 + i, " ".join(rng.choice(["zzqx", "#### 11", "$$ 9", "kkw"]) + str(rng.random()) for _ in range(300)), "es", "hot")
            for i in range(240)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in Q.quality(docs).collect()}
    assert all(kept[i] for i in range(80))
    assert sum(kept[1000 + i] for i in range(240)) == 0


@pytest.mark.parametrize("bound", [Q.BROADCAST_LANGUAGES, 10])
def test_every_language_has_its_own_reference(spark, monkeypatch, bound):
    monkeypatch.setattr(Q, "BROADCAST_LANGUAGES", bound)
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(i, text if i % 3 else text.upper(), f"x{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = Q.quality(docs).collect()
    assert len(out) == 300
    # a language's only document lies at distance 0 from its own reference
    assert all(r.char_distance == pytest.approx(0, abs=1e-6) for r in out)
