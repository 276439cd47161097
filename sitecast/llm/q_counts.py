"""Query op9_token_counts: tokens of every line of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitecast.llm.common import table
from sitecast.llm.q_bpe import RANKS
from sitecast.llm.token_counts import attribute


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, section, begin, end, n_tokens, n_crossing for every line. Not
    expressible in SQL: tests compare it with token spans of the library."""
    return attribute(table(spark, sf_dir, "documents"), RANKS, rule="first")


QUERIES = {"op9_token_counts": op9_token_counts}
ORACLE: dict[str, str] = {}
