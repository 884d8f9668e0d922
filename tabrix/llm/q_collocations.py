"""Query of phrase collocation mining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabrix.llm.collocations import collocations
from tabrix.llm.common import table


def op12_hat_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, p FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)
), lists AS (
  SELECT lang, piece, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM pieces
), starts AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM lists
), grams AS (
  SELECT lang, m, list_slice(ws, i, i + m - 1) AS g, count(*) AS f
  FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE i + m - 1 <= len(ws)
  GROUP BY ALL
), frequent AS (
  SELECT * FROM grams WHERE f >= 100
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE m = 1 GROUP BY lang
), inner_ones AS (
  SELECT lang, m - j AS m, list_slice(g, s, s + m - j - 1) AS g, max(f) AS f
  FROM (SELECT *, unnest(range(1, j + 2)) AS s FROM (SELECT *, unnest(range(1, m - 1)) AS j FROM frequent WHERE m >= 3))
  GROUP BY ALL
), kept AS (
  SELECT c.lang, c.m, c.g, c.f AS a FROM frequent c
  WHERE c.m >= 2 AND NOT EXISTS (SELECT 1 FROM inner_ones x WHERE x.lang = c.lang AND x.m = c.m AND x.g = c.g AND 100 * x.f >= 100 * c.f)
), cuts AS (
  SELECT lang, m, g, a, unnest(range(1, m)) AS k FROM kept
), scored AS (
  SELECT c.lang, c.g, c.a, c.k, l.f AS l, r.f AS r, t.n,
         CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts c JOIN totals t USING (lang)
  JOIN frequent l ON l.lang = c.lang AND l.m = c.k AND l.g = list_slice(c.g, 1, c.k)
  JOIN frequent r ON r.lang = c.lang AND r.m = c.m - c.k AND r.g = list_slice(c.g, c.k + 1, c.m)
), worst AS (
  SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS cut FROM scored
), ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM worst WHERE cut = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
