"""Query op4_bpe: encode and decode every document."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.llm import bpe
from sitecast.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document. Not
    expressible in SQL: tests compare it with the tiktoken library."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), RANKS)
    return bpe.decode(encoded, RANKS).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op4_bpe": op4_bpe}
ORACLE: dict[str, str] = {}
