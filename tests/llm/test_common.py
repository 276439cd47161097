"""Shared helpers: hashing of words, semi joins by list, samples, stored tables."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitecast.llm import common as C
from sitecast.session import path_exists

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aAzZ é世\t\n .", max_size=30), min_size=1, max_size=6))
def test_word_hashes_tell_words_apart(texts):
    raw = [t.encode() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
    h, cut = C.word_hashes(np.frombuffer(b"".join(raw), np.uint8), bounds)
    words = [WORD.findall(t) for t in texts]
    assert np.diff(cut).tolist() == [len(w) for w in words]
    lower = str.maketrans(C.UPPER, C.LOWER)
    flat = [w.translate(lower) for ws in words for w in ws]
    for i, a in enumerate(flat):
        for j, b in enumerate(flat):
            assert (a == b) == (h[i] == h[j])


def test_sub_batches_cover_all_rows():
    texts = ["", "a" * 10, "bb", None, "c" * 50, "é"]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(6)), "text": pa.array([t or "" for t in texts])})
    for limit in (1, 12, 1000):
        got = []
        for part, data, bounds in C.sub_batches(iter([batch, batch.slice(2, 3), batch.slice(0, 0)]), limit=limit):
            got += [(i, data[a:b].tobytes().decode()) for i, a, b in zip(part.column(0).to_pylist(), bounds, bounds[1:])]
        assert got == [(i, t or "") for i, t in enumerate(texts)] + [(i, texts[i] or "") for i in (2, 3, 4)]


def test_among_both_ways(spark, docs, monkeypatch):
    ids = spark.createDataFrame([(1,), (5,), (5,), (None,), (77,)], "i long")
    for bound in (C.MAX_IDS, 0):
        monkeypatch.setattr(C, "MAX_IDS", bound)
        kept = C.among(docs, ids, "doc_id")
        gone = C.among(docs, ids, "doc_id", keep=False)
        assert kept.columns == gone.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [1, 5, 5]
        assert sorted(r.doc_id or 0 for r in gone.collect()) == [-3, 0, 2, 3, 4, 6, 7, 8, 9, 10]
    none = spark.createDataFrame([], "i long")
    assert C.among(docs, none, "doc_id").count() == 0
    assert C.among(docs, none, "doc_id", keep=False).count() == docs.count()


def test_bounded_sample(spark):
    rows = spark.range(5000).selectExpr("id", "1 AS hot")
    assert C.bounded_sample(rows, 50, "id").count() == 50
    assert C.bounded_sample(rows, 50, "hot").count() == 50
    assert C.bounded_sample(rows.limit(7), 50, "id").count() == 7
    assert C.bounded_sample(rows.limit(0), 50, "id").count() == 0


def test_a_sample_is_the_same_in_any_layout(spark):
    rows = spark.range(10_000).selectExpr("id", "id % 7 AS other")
    picks = [{r.id for r in C.bounded_sample(rows.repartition(n), 200, "id").collect()} for n in (1, 4, 9)]
    assert picks[0] == picks[1] == picks[2] and len(picks[0]) == 200
    alone = {r.id for r in rows.orderBy(F.xxhash64("id"), "id").limit(200).collect()}
    assert picks[0] == alone


def test_stored_tables_lie_in_the_shared_folder(spark, docs):
    t = C.store(docs, "unit")
    assert t.scratch.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert t.count() == docs.count() and t.columns == docs.columns
    C.drop_stored(t)
    assert not path_exists(spark, t.scratch)
