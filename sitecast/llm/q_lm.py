"""Query op8_kneser_ney and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitecast.llm.common import LOWER, UPPER, table
from sitecast.llm.kneser_ney import lm_scores


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return lm_scores(table(spark, sf_dir, "documents"))


def _discount(n: str, k: int) -> str:
    """Discount for count ``k`` from the numbers n1 .. n4 of row ``n``."""
    y = f"CASE WHEN {n}.n1 > 0 THEN {n}.n1 / ({n}.n1 + 2 * {n}.n2)::DOUBLE ELSE 0 END"
    return (f"CASE WHEN {n}.n{k} > 0 THEN least({k}.0, greatest(0, {k} - {k + 1} * ({y}) * {n}.n{k + 1} / {n}.n{k})) "
            "ELSE 0 END")


def _counts(of: str) -> str:
    return ", ".join(f"count(*) FILTER ({of} = {k})::DOUBLE AS n{k}" for k in (1, 2, 3, 4))


SQL = rf"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS rid,
         xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN regexp_extract_all(doc_id::VARCHAR, '.')]),
             lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT FOR i IN range(8)]),
             lambda a, z: xor(a >> 1, 3988292384::BIGINT * (a & 1)))), 4294967295::BIGINT) % 7 = 2 AS held_out,
         list_append(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+'), '') AS w
  FROM documents),
tok AS MATERIALIZED (
  SELECT rid, held_out, unnest(w) AS word, unnest(list_prepend(' ', w[:len(w) - 1])) AS prev FROM docs),
uni AS MATERIALIZED (SELECT word, count(*) AS c FROM tok WHERE NOT held_out GROUP BY word),
pair AS MATERIALIZED (SELECT prev, word, count(*) AS c FROM tok WHERE NOT held_out GROUP BY prev, word),
ctx AS MATERIALIZED (
  SELECT prev, sum(c)::DOUBLE AS c, count(*) FILTER (c = 1) AS n1, count(*) FILTER (c = 2) AS n2,
         count(*) FILTER (c >= 3) AS n3 FROM pair GROUP BY prev),
cont AS MATERIALIZED (SELECT word, count(*) AS k FROM pair GROUP BY word),
tot AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM uni),
nd AS (SELECT {_counts('c')} FROM pair),
ne AS (SELECT {_counts('k')}, count(*) FILTER (k >= 3) AS m3, coalesce(sum(k), 0)::DOUBLE AS total FROM cont),
d AS (SELECT {', '.join(f"{_discount('nd', k)} AS d{k}" for k in (1, 2, 3))} FROM nd),
e AS (SELECT *, CASE WHEN total > 0 THEN (e1 * n1 + e2 * n2 + e3 * m3) / total ELSE 1 END AS spare FROM (
  SELECT ne.*, {', '.join(f"{_discount('ne', k)} AS e{k}" for k in (1, 2, 3))} FROM ne)),
scored AS (
  SELECT rid, coalesce(uni.c, 0) AS wc, tot.n, tot.v,
         greatest(coalesce(k, 0) - CASE coalesce(k, 0) WHEN 0 THEN 0 WHEN 1 THEN e1 WHEN 2 THEN e2 ELSE e3 END, 0)
           / greatest(1, total) + spare / (tot.v + 1) AS q,
         ctx.c AS cc, coalesce(pair.c, 0) AS pc, (d1 * ctx.n1 + d2 * ctx.n2 + d3 * ctx.n3) / ctx.c AS g, d1, d2, d3
  FROM tok CROSS JOIN tot CROSS JOIN d CROSS JOIN e LEFT JOIN uni USING (word) LEFT JOIN cont USING (word)
  LEFT JOIN ctx ON ctx.prev = tok.prev LEFT JOIN pair ON pair.prev = tok.prev AND pair.word = tok.word)
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (wc > 0) AS n_known, any_value(n) AS train_tokens,
       sum(log10((wc + 1) / (n + v + 1)::DOUBLE)) AS base_score,
       sum(log10(CASE WHEN cc IS NULL THEN q ELSE greatest(pc - CASE pc WHEN 0 THEN 0 WHEN 1 THEN d1 WHEN 2 THEN d2
         ELSE d3 END, 0) / cc + g * q END)) AS score
FROM scored JOIN docs USING (rid) GROUP BY rid, doc_id, held_out
"""

QUERIES = {"op8_kneser_ney": op8_kneser_ney}
ORACLE = {"op8_kneser_ney": SQL}
