"""Query op5_ngram_join and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitecast.llm.common import LOWER, UPPER, table
from sitecast.llm.ngram_join import jaccard_components


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return jaccard_components(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
         ELSE [w[i:i + 4] FOR i IN range(1, len(w) - 3)] END) AS s FROM words),
items AS MATERIALIZED (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS g FROM sets),
pairs AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
   AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT x, y FROM pairs UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(r.y), s.doc_id)) AS component_id
FROM sets s LEFT JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, s.s
"""

QUERIES = {"op5_ngram_join": op5_ngram_join}
ORACLE = {"op5_ngram_join": SQL}
