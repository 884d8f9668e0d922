"""Query of near-duplicate detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabrix.llm.common import table
from tabrix.llm.setsketch import near_duplicates


def op5_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS i FROM w)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)
), ends AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, ends.y FROM reach JOIN ends ON reach.y = ends.x
), least_one AS (
  SELECT x, min(y) AS root FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, root AS component_id, root = d.doc_id AS kept
FROM documents d JOIN least_one ON x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
