"""op11: reversed search against plain Python."""

import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sitecast.llm import reversed_search as R
from sitecast.llm.common import LOWER, UPPER

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CASE = str.maketrans(UPPER, LOWER)


def terms(text):
    return TERM.findall((text or "").translate(CASE))


def brute(docs, items, top=R.TOP):
    held = [(i, terms(t)) for i, t in docs]
    n_docs = sum(1 for _, t in held if t)
    n_terms = sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in wanted.items():
        found = []
        for i, t in held:
            m = 100 - 90 + 90 * len(t) * n_docs // n_terms if t else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    * ((1_000_000_000 * t.count(x)) // (1000 * t.count(x) + 8 * m)) for x in words if x in t)
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, "clash", 1) for r in docs], "doc_id long, text string, item_id string, rank int")
    i = spark.createDataFrame([(*r, 1.5) for r in items], "item_id long, text string, score double")
    out = R.search(d, i, **more)
    assert [f.simpleString() for f in out.schema] == ["item_id:bigint", "rank:int", "doc_id:bigint", "score:bigint"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aAzZ09é世\t\n .-_{\x00", max_size=20), min_size=1, max_size=6))
def test_terms_of_every_text(texts):
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
    h, doc = R.term_hashes(np.frombuffer(b"".join(raw), np.uint8), bounds)
    flat = [(n, w) for n, t in enumerate(texts) for w in terms(t)]
    assert doc.tolist() == [n for n, _ in flat]
    assert len({w for _, w in flat}) == len(set(h.tolist()))
    by_hash = {}
    for x, (_, w) in zip(h.tolist(), flat):
        assert by_hash.setdefault(x, w) == w


@pytest.mark.parametrize("block_terms, cells", [(R.BLOCK_TERMS, R.MAX_CELLS), (1, 1), (20, 7)])
def test_random_tables(spark, monkeypatch, block_terms, cells):
    monkeypatch.setattr(R, "MAX_CELLS", cells)
    rng = random.Random(cells)
    words = ["a", "B", "b", "c9", "é", "É", "d-e", "f", "g", "h"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(rng.randint(0, n)))
    docs = [(rng.choice([None, *range(30)]), rng.choice([None, "", "..", text(12), text(4)])) for _ in range(90)]
    items = [(rng.choice([None, *range(12)]), rng.choice([None, "", text(4), text(9)])) for _ in range(20)]
    assert run(spark, docs, items, block_terms=block_terms) == brute(docs, items)
    assert run(spark, docs, items, top=3) == brute(docs, items, 3)


def test_awkward_rows(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "the cat on the log"), (2, None), (3, "ÄÖ naïve w5 word976")], "item_id long, text string")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    assert sorted((tuple(r) for r in R.search(docs, items).collect()), key=str) == want
    assert R.search(no_docs, items).count() == 0
    assert R.search(docs, items.limit(0)).count() == 0


def test_ties_across_tasks_go_to_the_smallest_ids(spark):
    docs = spark.range(1000).repartition(7).selectExpr("id AS doc_id", "if(id % 2 = 0, 'needle in hay', 'hay only here') AS text")
    items = spark.createDataFrame([(1, "needle")], "item_id long, text string")
    got = R.search(docs, items).orderBy("rank").collect()
    assert [r.doc_id for r in got] == list(range(0, 20, 2)) and len({r.score for r in got}) == 1


def test_products_beyond_64_bits():
    n = np.array([3, 10**9, 3])
    assert R.length_factors(n, 10**12, 10**15).tolist() == [10, 10 + 90 * 10**9 * 10**12 // 10**15, 10]


def test_heaps_stay_bounded():
    rng = np.random.default_rng(5)
    heaps = R.Heaps(4, 10)
    rows = []
    for _ in range(50):
        item, doc, score = rng.integers(0, 4, 40), rng.integers(0, 500, 40), rng.integers(0, 6, 40)
        rows += list(zip(item.tolist(), (-score).tolist(), doc.tolist()))
        heaps.add(item, doc, score)
        assert len(heaps.item) <= 40
    want = [r for k in range(4) for r in sorted(x for x in rows if x[0] == k and x[1] < 0)[:10]]
    assert list(zip(heaps.item.tolist(), (-heaps.score).tolist(), heaps.id.tolist())) == want
