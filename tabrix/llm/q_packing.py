"""Query of best-fit packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.llm import packing
from tabrix.llm.common import staged, table


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary())
    narrow = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(staged(narrow, "packing-pieces"), ["doc_id", "piece"])
