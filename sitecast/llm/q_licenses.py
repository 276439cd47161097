"""Query op10_licenses: licence paragraphs of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitecast.llm.common import table
from sitecast.llm.licenses import scan


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, paragraph, line, family, probability, similarity, confirmed. A trained
    model is not expressible in SQL: tests check it on held-out notices, and its
    rows against a brute-force version that has the fitted weights."""
    return scan(table(spark, sf_dir, "documents"))


QUERIES = {"op10_licenses": op10_licenses}
ORACLE: dict[str, str] = {}
