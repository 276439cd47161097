"""Corpus pipeline over ``documents``: each stage's rows are written as Parquet
and read again as the next stage's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.llm import bpe, decontam, ngram_join, quality
from sitecast.llm.common import store, table
from sitecast.llm.q_bpe import RANKS


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and the digest of the bytes
    they decode to."""
    encoded = bpe.encode(docs, RANKS)
    return bpe.decode(encoded, RANKS).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return ngram_join.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within the error budget go."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


STAGES = [("quality", quality_stage), ("near_duplicates", join_stage),
          ("decontaminate", decontaminate_stage), ("encode", encode_stage)]

#: The last stage runs pair merges, which SQL cannot express; tests compare the
#: pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = store(docs, f"pipeline-{name}")
    return docs
