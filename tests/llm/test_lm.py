"""op8: the model against a plain dictionary version."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sitecast.llm import kneser_ney as K
from sitecast.llm import shard_files as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), ""]


def plain_model(texts):
    pair, word = Counter(), Counter()
    for t in texts:
        w = tokens(t)
        word.update(w)
        pair.update(zip([" ", *w], w))
    after, before = defaultdict(Counter), Counter(w for _, w in pair)
    for (v, w), n in pair.items():
        after[v][w] = n
    of = lambda values: [sum(x == k for x in values) for k in (1, 2, 3, 4)]

    def discount(n):
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        d = [min(k, max(0, k - (k + 1) * y * n[k] / n[k - 1])) if n[k - 1] else 0 for k in (1, 2, 3)]
        return lambda c: 0 if c == 0 else d[min(c, 3) - 1]

    d, e = discount(of(pair.values())), discount(of(before.values()))
    total = sum(before.values())
    spare = sum(e(k) for k in before.values()) / total if total else 1

    def q(w):
        k = before[w]
        return max(k - e(k), 0) / max(1, total) + spare / (len(word) + 1)

    def p(v, w):
        if v not in after:
            return q(w)
        n = sum(after[v].values())
        c = after[v][w]
        return max(c - d(c), 0) / n + sum(d(x) for x in after[v].values()) / n * q(w)

    return word, p


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    word, p = plain_model([t for i, t in rows if not out(i)])
    n, v = sum(word.values()), len(word)
    got = sorted(K.lm_scores(df).collect(), key=str)
    want = []
    for i, t in rows:
        w = tokens(t)
        want.append((i, out(i), len(w), sum(word[x] > 0 for x in w), n,
                     sum(math.log10((word[x] + 1) / (n + v + 1)) for x in w),
                     sum(math.log10(p(a, b)) for a, b in zip([" ", *w], w))))
    assert len(got) == len(want)
    for g, x in zip(sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[6])),
                    sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[6]))):
        assert tuple(g[:5]) == x[:5]
        assert g[5:] == pytest.approx(x[5:])


def test_scores(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(100 + i, " ".join(f"w{(i * j) % 13}" for j in range(1, 40))) for i in range(30)]
    check(spark, rows)


def test_no_training_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    check(spark, [(held, "some words")])


def test_empty_table(no_docs):
    assert K.lm_scores(no_docs).count() == 0


def test_probabilities_add_up_to_one():
    word, p = plain_model(["a b a c", "a b b d", "c a b"])
    for v in [" ", "a", "b", "zzz"]:
        assert sum(p(v, w) for w in [*word, "unseen"]) == pytest.approx(1)


def test_shard_files(tmp_path):
    a, b = np.array([2, 5, 9], "<u8"), np.array([7, 8, 1], "<u4")
    for uri in (f"{tmp_path}/x/f-1", f"file://{tmp_path}/y/f-1"):
        S.write_arrays(uri, [a, b])
        S.write_arrays(uri, [a, b])  # a task that ran twice
        with S.MappedArrays(uri, ["<u8", "<u4"]) as (x, y):
            assert x.tolist() == a.tolist() and y.tolist() == b.tolist()
            assert [v.tolist() for v in S.lookup(x, np.array([1, 5, 10], np.uint64))] == [[0, 1, 2], [False, True, False]]
            del x, y
    S.write_arrays(f"{tmp_path}/e", [a[:0]])
    with S.MappedArrays(f"{tmp_path}/e", ["<u8"]) as (x,):
        assert len(x) == 0
        del x


def test_many_shards_and_wide_counts(spark, docs, monkeypatch):
    monkeypatch.setattr(K, "SHARD_BYTES", 1000)
    monkeypatch.setattr(K, "MOST_NARROW", 2)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(spark, rows + [(100 + i, " ".join(f"w{(i * j) % 13}" for j in range(1, 40))) for i in range(60)])


def test_wide_counts_are_exact():
    many = np.array([3_000_000_000, 3_000_000_000], np.int64)
    assert K.add_up(np.array([7, 7], np.uint64), many)[2].tolist() == [6_000_000_000]
    assert np.dtype(K.WIDE[1]).itemsize == 8


def test_shards_follow_the_text(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "SHARD_BYTES", 100)
    for n in (5, 50):
        docs = spark.createDataFrame([(i, "some words of a text") for i in range(n)], "doc_id long, text string")
        assert K.train(docs, f"{tmp_path}/{n}").shards == max(4, n * 20 // 100)


def test_open_files_are_bounded(tmp_path):
    a = np.array([2, 5, 9], "<u8")
    files = S.OpenArrays(most_files=2)
    for k in range(5):
        S.write_arrays(f"{tmp_path}/f-{k}", [a + np.uint64(k)])
    for k in (0, 1, 2, 0, 3, 4, 0):
        assert files.get(f"{tmp_path}/f-{k}", ["<u8"])[0].tolist() == (a + np.uint64(k)).tolist()
        assert len(files.open) <= 2
    assert files.get(f"{tmp_path}/f-0", ["<u8"])[0] is files.get(f"{tmp_path}/f-0", ["<u8"])[0]
