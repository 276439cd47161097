"""Query op1_token_output: write every document's ids and read them back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sitecast.llm.common import scratch_path, table
from sitecast.llm.token_output import read_tokens, write_tokens

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the written
    files. Not expressible in SQL: tests compare it with the library."""
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, TOKENIZER, end_id=2, added=True)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {"op1_token_output": op1_token_output}
ORACLE: dict[str, str] = {}
