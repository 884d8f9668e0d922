"""Query of embedding whitening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.llm.common import table
from tabrix.llm.whitening import whiten


def op11_multiplicity_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("i", "c")
    return out.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", each).select(
        "vec_id", (F.col("i") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"), "identity_error")
