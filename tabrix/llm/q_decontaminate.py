"""Query of benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.llm.common import table
from tabrix.llm.decontaminate import decontaminate


def op4_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, "text", table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, {_WORDS} AS ws FROM documents
), phrases AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(list_slice(ws, i, i + 9), ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, least(len(ws), 1)) + 1)) AS i FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark))
), places AS (
  SELECT doc_id, m, i, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS g
  FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM phrases) WHERE len(ws) >= m)
), hits AS (
  SELECT doc_id, i, m, item_id FROM places JOIN phrases USING (m, g)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM (SELECT DISTINCT doc_id, i, m FROM hits)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
"""
