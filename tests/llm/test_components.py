"""Connected components: few rounds however the nodes are numbered."""

import random

import pytest

from sitecast.llm import components as K


def chain(order):
    return list(zip(order, order[1:]))


def zigzag(n):
    out = []
    for i in range(n // 2):
        out += [i, n - 1 - i]
    return out


def expected(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in list(parent)}


def run(spark, monkeypatch, edges):
    rounds = []
    original = K.contract
    monkeypatch.setattr(K, "contract", lambda e, seed: rounds.append(seed) or original(e, seed))
    df = spark.createDataFrame(edges, "a long, b long")
    got = [tuple(r) for r in K.connected_components(df).collect()]
    monkeypatch.setattr(K, "contract", original)
    assert len(got) == len(dict(got)) and dict(got) == expected(edges)
    return len(rounds)


@pytest.mark.parametrize("order", [list(range(1000)), list(range(1000))[::-1], zigzag(1000)], ids=["sorted", "reversed", "zigzag"])
def test_chains_of_a_thousand_nodes(spark, monkeypatch, order):
    assert run(spark, monkeypatch, chain(order)) <= 12


def test_mixed_graph(spark, monkeypatch):
    rng = random.Random(4)
    edges = [(0, i) for i in range(1, 300)] + [(5000 + rng.randrange(90), 5000 + rng.randrange(90)) for _ in range(60)]
    edges += [(7, 7), (-4, -9), (-9, -4), (8000, 8001), (8000, 8001)]
    assert run(spark, monkeypatch, edges) <= 8


def test_no_edges(spark):
    none = spark.createDataFrame([(1, 1)], "a long, b long")
    assert K.connected_components(none).collect() == [] and K.connected_components(none.limit(0)).columns == ["node", "component"]
