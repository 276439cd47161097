"""op12: spelling variants against plain Python."""

import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitecast.llm import spelling as S
from sitecast.llm.common import LOWER, UPPER

CASE = str.maketrans(UPPER, LOWER)


def counts(docs, min_chars=S.MIN_CHARS, min_count=S.MIN_COUNT):
    n = {}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(CASE)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % S.DAMAGE_MOD == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] = n.get(run, 0) + 1
    return {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(n):
    form, out = {}, {}
    for w, c in n.items():
        around = [(-n[x], x) for x in n if near(w, x)]
        best = min(around, default=None)
        form[w] = best[1] if best and -best[0] >= S.FORM_RATIO * c else None
        out[w] = (c, len(around), form[w], -best[0] if form[w] else None)
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] += (root,)
    return out


def rows(out):
    assert out.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    got = out.collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: tuple(r)[1:] for r in got}


@settings(max_examples=150, deadline=None)
@given(st.text("abcé", min_size=3, max_size=8), st.text("abcé", min_size=3, max_size=8), st.integers(2, 7))
def test_near_words_share_a_signature(a, b, parts):
    if near(a, b):
        flips = 2 if len(a) == len(b) else 1
        if flips < parts:
            sigs, parity, _ = S.word_signatures([a, b], parts, flips)
            assert (sigs[0] == sigs[1]).any()
        assert bin(int(parity[0] ^ parity[1])).count("1") <= 2 if flips < parts else True


def mutate(rng, w, letters="abcdeé"):
    k = rng.randrange(len(w))
    return rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1:]])


@pytest.mark.parametrize("heavy, parts", [(S.HEAVY, S.PARTS), (2, 4), (0, 3)])
def test_random_words(spark, heavy, parts):
    rng = random.Random(heavy)
    words = {}
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 10))) for _ in range(40)]
    for w in base:
        words[w] = rng.choice([1, 9, 500])
        for _ in range(6):
            w = mutate(rng, w)
            words.setdefault(w, rng.choice([1, 2, 10, 90]))
    table = spark.createDataFrame([*words.items()], "word string, n long")
    forms = S.variant_forms(table, parts=parts, heavy=heavy)
    got = {r.word: tuple(r)[1:] for r in forms.collect()}
    want = brute(words)
    assert got == {w: v[:4] for w, v in want.items()}
    assert {r.word: r.root for r in S.roots(forms).collect()} == {w: v[4] for w, v in want.items() if v[2]}


def test_whole_texts(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdeÉé") for _ in range(rng.randint(6, 9))) for _ in range(15)]
    docs = [(rng.choice([None, *range(40)]), rng.choice([None, "", " ".join(rng.choice(base) for _ in range(60)),
                                                        "; ".join(mutate(rng, rng.choice(base)) for _ in range(9))]))
            for _ in range(120)]
    df = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, word string")
    assert rows(S.spelling_variants(df)) == brute(counts(docs))


def test_ways_of_many_steps(spark):
    words = {"abcdefg" + "h" * k: 10 ** (12 - k) for k in range(10)}
    forms = spark.createDataFrame([(f"abcdefg{'h' * k}", f"abcdefg{'h' * (k - 1)}" if k else None) for k in range(10)],
                                  "word string, form string")
    assert {r.word: r.root for r in S.roots(forms).collect()} == {w: "abcdefg" for w in words if w != "abcdefg"}


def test_awkward_rows(spark, docs, no_docs):
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = rows(S.spelling_variants(docs, min_chars=3))
    assert got == brute(counts(pairs, min_chars=3))
    assert S.spelling_variants(no_docs).count() == 0
    long_word = "q" * 200_000
    twice = spark.createDataFrame([(1, f"{long_word} {long_word}"), (2, f"{long_word}x {long_word}x")], "doc_id long, text string")
    assert {(len(r.word), r.n_near) for r in S.spelling_variants(twice).collect()} == {
        (len(w), sum(near(w, x) for x in c)) for c in [counts([(1, f"{long_word} {long_word}"), (2, f"{long_word}x {long_word}x")])]
        for w in c}


def test_pairs_are_joined_by_equality(spark):
    words = spark.createDataFrame([("abcdefg", 3)], "word string, n long")
    plan = S.near_pairs(words)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    counted = S.count_words(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string"))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Python" not in plan
    assert S.signature_rows(words, 2).agg(F.count("*")).first()[0] == 15
