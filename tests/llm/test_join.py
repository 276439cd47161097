"""op5: components against brute force, and the parts of the join."""

import random
import re

import numpy as np
import pytest

from sitecast.llm import ngram_join as J
from sitecast.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """{doc_id: component}; rows of one id are one node."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1:]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(i), find(j)))
                root[hi] = lo
    return {i: find(i) for i in root}


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, component_id string, n int")
    got = J.jaccard_components(df).collect()
    want = brute(rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles) for r in got) == sorted(
        (i is None, i or 0, len(shingles(t))) for i, t in rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        k = rng.randrange(len(w))
        w[k:k + 1] = rng.choice([[], [f"new{rng.randrange(9999)}"], [w[k], f"more{rng.randrange(9999)}"]])
    return " ".join(w)


def test_near_copies_chains_and_shared_passages(spark):
    rng = random.Random(5)
    rows, n = [], 100
    for size in (5, 6, 8, 12, 14, 18, 24, 40, 90, 300):
        base = [f"b{size}x{i}" for i in range(size)]
        for edits in (0, 0, 1, 1, 2, 3, 5, 8):
            rows.append((n, edited(rng, base, edits)))
            n += 1
        text = base
        for _ in range(4):  # a chain
            text = edited(rng, text, 1 + size // 60).split(" ")
            rows.append((n, " ".join(text)))
            n += 1
    passage = " ".join(f"common{i}" for i in range(60))
    rows += [(n + i, passage + " " + " ".join(f"own{i}y{j}" for j in range(rng.choice((3, 6, 10, 40))))) for i in range(60)]
    rng.shuffle(rows)
    base = " ".join(f"w{i}" for i in range(30))
    check(spark, rows + [
        (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, base),
        (8, base.upper()), (8, base.upper()), (9, "x y z q r s"), (9, base), (9, ""), (10, "x y z q r s"),
        (None, base), (11, "ÄB c d e f"), (12, "äb c d e f"), (-5, base + " end")])


def test_tiny_frequent_table_and_shuffle_path(spark, monkeypatch):
    """Which shingles count as frequent, and whether ids are broadcast or
    joined, changes nothing."""
    from sitecast.llm import common
    monkeypatch.setattr(J, "FREQUENT", 2)
    monkeypatch.setattr(J, "MAX_FREQUENT", 50)
    monkeypatch.setattr(common, "MAX_IDS", 0)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(80)]
    check(spark, [(i, edited(rng, base, rng.randrange(6))) for i in range(80)])


@pytest.mark.parametrize("small", [0, 16])
def test_any_boundary_gives_the_same(spark, monkeypatch, small):
    monkeypatch.setattr(J, "boundary", lambda sizes, length: small)
    rng = random.Random(small)
    rows = []
    for size in range(5, 26):
        base = [f"s{size}x{i}" for i in range(size)]
        rows += [(100 * size + k, edited(rng, base, k % 3)) for k in range(6)]
    check(spark, rows)


def test_boundary_prefers_the_cheaper_side():
    assert J.boundary({500: 10}, 2.0) in range(J.MAX_SMALL + 1)
    assert J.boundary({1: 1000, 2: 1000}, 50.0) >= 2
    assert J.boundary({16: 1000}, 0.0) < 16


def test_small_sets_meet_in_a_subset():
    rng = random.Random(8)
    for _ in range(300):
        a = rng.sample(range(40), rng.randrange(1, 12))
        b = a + rng.sample(range(50, 60), 1) if rng.random() < 0.5 else a[:-1] or a
        x, y = np.unique(np.array(a, np.uint64)), np.unique(np.array(b, np.uint64))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 80 * (len(x) + len(y) - both):
            assert set(J.subset_keys(x)) & set(J.subset_keys(y))


def test_sketches_never_rule_out_a_link():
    rng = np.random.RandomState(3)
    for _ in range(400):
        n = rng.randint(1, 300)
        x = np.unique(rng.randint(0, 2**62, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[rng.rand(len(x)) < rng.rand()], rng.randint(0, 2**62, rng.randint(0, 60)).astype(np.uint64)]))
        differ = len(np.setxor1d(x, y))
        bound = J.least_difference(J.parity_sketch(x), J.parity_sketch(y))
        assert bound <= differ and (bound - differ) % 2 == 0
        assert J.least_difference(J.parity_sketch(x), J.parity_sketch(x)) == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage(spark, docs, no_docs):
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert ids == [(False, i) for i in (-3, 1, 2, 3, 4, 5, 7, 8, 10)] + [(True, 0)]
    assert J.keep_one(no_docs).count() == 0
