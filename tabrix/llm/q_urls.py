"""Query of the URL filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabrix.llm.common import table
from tabrix.llm.urls import DAMPING, MARGIN, ROUNDS, Rule, judge_urls

RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def op13_link_graph_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return judge_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


_FIT = """CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN '{0}'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN '{1}'
            WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN '{2}'
            WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN '{3}' END"""

OP13_SQL = f"""
WITH RECURSIVE p AS (
  SELECT page_id, html,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), r AS (
  SELECT page_id, html, host, path,
         {_FIT.format('example.net/en/', 'example.com/de/', 'org/fr/', 'net/')} AS rule,
         {_FIT.format('allow', 'block', 'allow', 'block')} AS verdict
  FROM p
), seeds AS (
  SELECT CASE WHEN 2 * count_if(verdict = 'allow') > count(*) THEN 'trust'
              WHEN 2 * count_if(verdict = 'block') > count(*) THEN 'distrust' END AS kind, host
  FROM r WHERE host <> '' GROUP BY host
), links AS (
  SELECT DISTINCT id, src, translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM (SELECT row_number() OVER () AS id, host AS src,
               unnest(regexp_extract_all(coalesce(html, ''), 'href\\s*=\\s*["'']?\\s*(?:[a-z][a-z0-9+.\\-]*:)?//([^/?#"''\\s<>]+)', 1, 'i')) AS l FROM r)
), edges AS (
  SELECT src, dst, count(*) AS pages FROM links WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst
), moves AS (
  SELECT 'trust' AS kind, src AS host, dst AS target, pages / sum(pages) OVER (PARTITION BY src) AS share FROM edges
  UNION ALL SELECT 'distrust', dst, src, pages / sum(pages) OVER (PARTITION BY dst) FROM edges
), walk AS (
  SELECT 0 AS step, kind, host, {1 - DAMPING} AS mass FROM seeds WHERE kind IS NOT NULL
  UNION ALL
  SELECT step + 1, kind, target, sum(mass * share * {DAMPING}) FROM walk JOIN moves USING (kind, host)
  WHERE step < {ROUNDS} GROUP BY step, kind, target
), bad AS (
  SELECT host FROM walk GROUP BY host HAVING round(sum(CASE kind WHEN 'trust' THEN -mass ELSE mass END), 9) > {MARGIN}
)
SELECT page_id, r.host, path, rule, coalesce(verdict, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN bad ON bad.host = r.host
"""
