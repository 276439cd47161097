"""Query op12_spelling_variants and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitecast.llm.common import LOWER, UPPER, table
from sitecast.llm.spelling import DAMAGE_MOD, FORM_RATIO, MIN_CHARS, MIN_COUNT, spelling_variants


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word."""
    return spelling_variants(table(spark, sf_dir, "documents"))


# crc32 bit by bit over the UTF-8 bytes of a text
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || hex(s)[2 * i - 1:2 * i])::BIGINT FOR i IN
  range(1, strlen(s) + 1)]), lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT FOR i IN range(8)]),
  lambda a, z: xor(a >> 1, 3988292384::BIGINT * (a & 1)))), 4294967295::BIGINT)"""

SQL = rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS s, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
                                             '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {MIN_CHARS} GROUP BY ALL),
hashed AS (SELECT run, c, {_CRC} AS h FROM runs),
words AS MATERIALIZED (
  SELECT w AS word, sum(c)::BIGINT AS n FROM (
    SELECT c, CASE WHEN h % {DAMAGE_MOD} = 0 THEN substr(run, 1, (h % length(run))::INT)
      || substr(run, (h % length(run))::INT + 2) ELSE run END AS w FROM hashed)
  WHERE length(w) >= {MIN_CHARS} GROUP BY w HAVING sum(c) >= {MIN_COUNT}),
gap AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT x.word AS x, y.word AS y FROM gap x JOIN gap y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT g.word, w.word FROM gap g JOIN words w ON w.word = g.a || g.b
  UNION SELECT w.word, g.word FROM gap g JOIN words w ON w.word = g.a || g.b),
best AS (
  SELECT x AS word, count(*) AS n_near, first(y ORDER BY n DESC, y) AS y, max(n) AS y_n
  FROM near JOIN words ON words.word = y GROUP BY x),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN y_n >= {FORM_RATIO} * n THEN y END AS form,
         CASE WHEN y_n >= {FORM_RATIO} * n THEN y_n END AS form_n FROM words LEFT JOIN best USING (word)),
way AS (
  SELECT word, word AS stop FROM forms UNION ALL
  SELECT way.word, form FROM way JOIN forms ON forms.word = way.stop WHERE form IS NOT NULL),
ends AS (SELECT way.word, stop AS root FROM way JOIN forms ON forms.word = way.stop WHERE form IS NULL)
SELECT word, n, n_near::BIGINT AS n_near, form, form_n, root FROM forms JOIN ends USING (word)
"""

QUERIES = {"op12_spelling_variants": op12_spelling_variants}
ORACLE = {"op12_spelling_variants": SQL}
