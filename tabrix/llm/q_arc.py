"""Query of the ARC to WARC converter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.llm import arc
from tabrix.llm.common import scratch_path, staged, table


def op10_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC files of both versions, converted to WARC files, and those read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    legacy, archive = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    secure = F.coalesce(F.col("url").startswith("https:"), F.lit(False))
    arc.write_arc(pages.where(~secure), f"{legacy}/v1", 1)
    arc.write_arc(pages.where(secure), f"{legacy}/v2", 2)
    arc.write_warc(arc.mark_revisits(arc.read_arc(spark, legacy, info=True)), archive)
    back = staged(arc.read_warc(spark, archive).where("record_type != 'warcinfo'"), "warc-index")
    named = back.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("first"))
    out = back.join(named, "refers_to", "left")
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("first").alias("refers_to"))


OP10_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p
), f AS (
  SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest
)
SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN f.first IS NOT NULL AND f.first <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> d.page_id THEN f.first END AS refers_to
FROM d LEFT JOIN f ON f.digest = d.digest AND d.n >= 100
"""
