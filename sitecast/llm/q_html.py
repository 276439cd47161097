"""Query op2_html_extract: main text of every page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.llm.common import table
from sitecast.llm.html_extract import main_text


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page. Not expressible in SQL: tests
    compare it with the marked content of pages."""
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op2_html_extract": op2_html_extract}
ORACLE: dict[str, str] = {}
