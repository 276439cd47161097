"""Query op7_decontam: benchmark items found in documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitecast.llm.common import table
from sitecast.llm.decontam import matches


def op7_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, edits of every benchmark item that a document holds
    within the error budget. Approximate substring search is not expressible in
    SQL: tests compare it with a brute-force search."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "edits")


QUERIES = {"op7_decontam": op7_decontam}
ORACLE: dict[str, str] = {}
