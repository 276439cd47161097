"""The pipeline against brute force, and the registration of the queries."""

import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from sitecast.llm import bpe, decontam
from sitecast.llm import quality as Q
from sitecast.llm.q_bpe import RANKS
from sitecast.plans.compare import compare, duck
from tests.llm.test_join import brute


def test_pipeline_by_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    good = {r.doc_id for r in Q.quality(docs).where("kept").collect()}  # itself tested against SQL
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id in good}
    groups = brute(list(texts.items()))
    texts = {i: t for i, t in texts.items() if groups[i] == i}
    matcher = decontam.Matcher([(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()],
                               decontam.BUDGET_CHARS)
    texts = {i: t for i, t in texts.items() if not matcher(t)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, d).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        ids = library.encode_ordinary(t)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_stages_keep_the_columns(spark, docs):
    rows = docs.select("doc_id", "text", "lang", docs.ids.alias("source")).selectExpr("*", "CAST(length(text) AS LONG) n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, rows, "/root/testdata/sf0.001").columns == rows.columns, name
        assert stage(spark, rows.limit(0), "/root/testdata/sf0.001").count() == 0, name


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.parametrize("name", ["op3_chat_format", "op5_ngram_join", "op6_quality", "op8_kneser_ney"])
def test_oracle(spark, name):
    d = "/root/testdata/sf0.001"
    got = compare(entry.queries()[name](spark, d), duck(d), entry.oracle_sql()[name])
    assert got["names"] and got["hash"] and got["types"], got
