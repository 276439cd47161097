"""op7: matches against a brute-force edit distance search."""

import random

import pytest

from sitecast.llm import decontam as D


def brute(item, text):
    m = len(item)
    prev = list(range(m + 1))
    best = m
    for c in text:
        cur = [0]
        for i in range(1, m + 1):
            cur.append(min(prev[i - 1] + (item[i - 1] != c), prev[i] + 1, cur[i - 1] + 1))
        prev = cur
        best = min(best, prev[m])
    return best


def test_myers():
    rng = random.Random(2)
    for _ in range(600):
        item = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("ab ") for _ in range(rng.randint(0, 120)))
        assert D.myers(item, D.char_masks(item), text)[0] == brute(item, text)


def test_matcher_finds_everything_within_the_budget():
    rng = random.Random(3)
    for _ in range(150):
        items = [(i, "".join(rng.choice("abcd ") for _ in range(rng.randint(0, 70)))) for i in range(5)]
        items.append((9, items[0][1]))
        planted = rng.choice(items)[1]
        for _ in range(rng.randint(0, 5)):
            if planted:
                k = rng.randrange(len(planted))
                planted = planted[:k] + rng.choice(["", "x", "yz"]) + planted[k + 1:]
        text = "".join(rng.choice("abcd ") for _ in range(90))
        text = text[:40] + planted + text[40:]
        want = {(i, d) for i, t in items if (n := D.normalise(t))
                and (d := brute(n, D.normalise(text))) <= len(n) // 10}
        assert {(i, d) for i, d, _ in D.Matcher(items, 10)(text)} == want


def test_pieces_cover_the_item():
    for edits in range(5):
        parts = D.pieces("abcdefghijk", edits)
        assert "".join(p for _, p in parts) == "abcdefghijk" and len(parts) == edits + 1


ITEM = "The quick brown fox jumps over the lazy dog while seven wizards quietly brew a potion."


@pytest.fixture
def tables(spark):
    near = ITEM.replace("wizards", "wizard").replace("quick ", "quick  ").upper()
    docs = spark.createDataFrame([
        (1, "noise " * 50 + ITEM + " noise" * 50, 5), (2, "x " + near, 5), (3, None, 5), (4, "", 5), (5, "clean text", 5),
        (6, ITEM[:40], 5), (None, ITEM, 5), (1, ITEM, 5), (7, "word " * 200_000 + ITEM, 5)], "doc_id long, text string, edits int")
    items = spark.createDataFrame([(10, ITEM, 1), (11, ITEM, 1), (12, None, 1), (13, "", 1), (14, "never there at all", 1)],
                                  "item_id long, text string, end int")
    return docs, items


def test_rows(tables):
    docs, items = tables
    got = sorted((r.doc_id or 0, r.item_id, r.edits) for r in D.matches(docs, items).collect())
    assert got == [(d, i, e) for d, e in ((0, 0), (1, 0), (2, 1), (7, 0)) for i in (10, 11)]


def test_blocks_give_the_same(tables):
    docs, items = tables
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert key(D.matches(docs, items)) == key(D.matches(docs, items, block_bytes=1))


def test_stage(tables):
    docs, items = tables
    kept = D.drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]


def test_empty_tables(tables):
    docs, items = tables
    assert D.matches(docs.limit(0), items).count() == 0
    assert D.matches(docs, items.limit(0)).count() == 0
    assert D.drop_leaks(docs, items.limit(0)).count() == docs.count()


def test_planted_passages(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    items = spark.read.parquet(f"{d}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in D.matches(docs, items).collect()}
    texts = {r.doc_id: D.normalise(r.text or "") for r in docs.collect()}
    whole = {(i, b.item_id) for b in items.collect() for i, t in texts.items() if D.normalise(b.text) in t}
    assert whole <= got and len(got) <= len(whole) + 2
