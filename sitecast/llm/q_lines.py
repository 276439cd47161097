"""Query op13_line_dedup and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitecast.llm.common import LOWER, UPPER, table
from sitecast.llm.line_dedup import MIN_CHARS, MIN_DOCS, dedup_lines


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of every document's kept text."""
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = rf"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS MATERIALIZED (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS k
  FROM lines),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= {MIN_CHARS}
  GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (SELECT doc_id, pos, line, coalesce(keeper <> doc_id, false) AS gone FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUERIES = {"op13_line_dedup": op13_line_dedup}
ORACLE = {"op13_line_dedup": SQL}
