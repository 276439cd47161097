"""Query op6_quality and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitecast.llm import quality as Q
from sitecast.llm.common import table


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return Q.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _distance(a: str, b: str) -> str:
    """Jensen-Shannon distance of two DuckDB lists of counts."""
    def half(p: str, q: str) -> str:
        return f"list_sum([CASE WHEN z[1] > 0 THEN {p} * log2(2 * {p} / (z[1] + z[2])) ELSE 0 END FOR z IN pq])".replace(
            "z[1] > 0", f"{p} > 0").replace("(z[1] + z[2])", f"({p} + {q})")
    pairs = f"[[x / list_sum({a}), {b}[i] / list_sum({b})] FOR x, i IN {a}]"
    return (f"(SELECT CASE WHEN list_sum({a}) > 0 AND list_sum({b}) > 0 THEN "
            f"sqrt(greatest(0, ({half('z[1]', 'z[2]')} + {half('z[2]', 'z[1]')}) / 2)) END FROM (SELECT {pairs} AS pq))")


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
SQL = rf"""
WITH raw AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t, {WORDS} AS w,
         CASE lang {' '.join(f"WHEN '{k}' THEN {_list(v)}" for k, v in Q.COMMON_WORDS.items())} END AS common
  FROM documents),
grams AS (
  SELECT rid, i, [w[i], w[i + 1], w[i + 2]] AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM raw)),
rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1),
cover AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
chars AS (
  SELECT *, regexp_replace(t, '\p{{L}}+', '', 'g') AS r1,
         [l FOR l IN string_split(t, chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines FROM raw),
counts AS (
  SELECT rid, doc_id, lang, source, len(w) AS n_words, len(list_filter(lines, lambda l: true)) - len(list_distinct(lines)) AS n_dup_lines,
         length(t) - length(regexp_replace(t, '\p{{Lu}}+', '', 'g')) AS upper,
         length(t) - length(r1) AS letters, length(r1) AS n1,
         length(regexp_replace(r1, '[\x20\x09-\x0D]+', '', 'g')) AS n2,
         length(r1) - length(regexp_replace(r1, '[0-9]', '', 'g')) AS digits,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) - length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS spaces, length(t) AS n_chars,
         CASE WHEN common IS NOT NULL THEN
           [len(list_filter(w, lambda x: x = c)) FOR c IN common] ||
           [len(list_filter(w, lambda x: NOT list_contains(common, x)))] END AS word_bins
  FROM chars),
bins AS (
  SELECT counts.*, [upper, letters - upper, digits, n_symbols, n2 - digits - n_symbols, n1 - n2] AS char_bins,
         coalesce(cover.n, 0) AS n_repeat_words,
         n_words < {Q.MIN_WORDS} OR 100 * coalesce(cover.n, 0) > 50 * n_words AS base_failed
  FROM counts LEFT JOIN cover USING (rid)),
per_source AS (
  SELECT lang, source, {', '.join(f"avg(char_bins[{i}] / list_sum(char_bins)) AS c{i}" for i in range(1, 7))},
         {', '.join(f"avg(word_bins[{i}] / list_sum(word_bins)) AS b{i}" for i in range(1, Q.WORD_BINS + 1))}
  FROM bins WHERE NOT base_failed GROUP BY lang, source),
ref AS (
  SELECT lang AS ref_lang, [{', '.join(f"avg(c{i})" for i in range(1, 7))}] AS own_ref,
         [{', '.join(f"avg(b{i})" for i in range(1, Q.WORD_BINS + 1))}] AS word_ref
  FROM per_source WHERE lang IS NOT NULL GROUP BY lang),
pooled AS (SELECT [{', '.join(f"avg(c{i})" for i in range(1, 7))}] AS all_ref FROM per_source),
joined AS (
  SELECT bins.*, coalesce(own_ref, all_ref) AS char_ref, word_ref
  FROM bins LEFT JOIN ref ON lang = ref_lang, pooled),
judged AS (
  SELECT *, CASE WHEN n_chars >= {Q.MIN_CHARS} THEN {_distance('char_bins', 'char_ref')} END AS char_distance,
         CASE WHEN n_words >= {Q.MIN_COMMON_WORDS} AND word_bins IS NOT NULL THEN {_distance('word_bins', 'word_ref')} END
           AS word_distance
  FROM joined)
SELECT doc_id, n_words::BIGINT AS n_words, (n_chars - spaces)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(char_distance > {Q.MAX_CHAR_DISTANCE}, false)
         AND NOT coalesce(word_distance > {Q.MAX_WORD_DISTANCE}, false) AS kept
FROM judged
"""

QUERIES = {"op6_quality": op6_quality}
ORACLE = {"op6_quality": SQL}
