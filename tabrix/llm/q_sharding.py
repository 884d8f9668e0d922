"""Query of the sharding operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.llm.common import staged, table
from tabrix.llm.sharding import HashTree, assign

#: 40 shards: five regions of two racks of four.
TREE = HashTree.regular(regions=5, racks=2, shards=4)


def op7_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    # the narrow rows are read twice (counts, then slots); the texts only once
    out = assign(staged(rows, "sharding-rows"), "doc_id", TREE, TREE.grown(), order=("size", "text_crc32"), buckets=64)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
