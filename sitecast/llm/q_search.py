"""Query op11_reversed_search and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitecast.llm.common import LOWER, UPPER, table
from sitecast.llm.reversed_search import TOP, search


def op11_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of every item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _terms(text: str) -> str:
    return (rf"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


SQL = rf"""
WITH doc AS (SELECT doc_id, {_terms('text')} AS w FROM documents),
tot AS (SELECT count(*)::HUGEINT AS n_docs, sum(len(w))::HUGEINT AS n_terms FROM doc WHERE len(w) > 0),
item AS MATERIALIZED (SELECT DISTINCT item_id, unnest({_terms('text')}) AS term FROM benchmark),
tf AS MATERIALIZED (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM doc)
  WHERE term IN (SELECT term FROM item) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
           FROM tf CROSS JOIN tot GROUP BY term),
part AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS s
  FROM tf JOIN weight USING (term) CROSS JOIN tot),
total AS (SELECT item_id, doc_id, sum(s)::BIGINT AS score FROM item JOIN part USING (term) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
           FROM total WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""

QUERIES = {"op11_reversed_search": op11_reversed_search}
ORACLE = {"op11_reversed_search": SQL}
