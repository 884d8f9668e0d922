"""The corpus pipeline over ``documents``: five of the training-data operators in turn.

Each stage takes the documents that its predecessor kept, with the columns of
``documents``, and its decisions take effect: rejected documents and copies go,
repeated and benchmark passages are cut out of the texts (``n_chars`` follows),
and the last stage packs what is left into training sequences.

Edge cases are those of the operators. A NULL text counts as empty; extra columns
are dropped; rows that repeat a document whole are one document after the second
stage; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabrix.llm import packing, quality
from tabrix.llm.common import scratch_path, staged, table
from tabrix.llm.decontaminate import decontaminate, remove_spans
from tabrix.llm.q_packing import vocabulary
from tabrix.llm.setsketch import near_duplicates
from tabrix.llm.substrings import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Shared shingles of near copies, in percent of all shingles of both.
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a certified threshold rejects go."""
    docs = docs.select(*COLUMNS)
    measured = staged(quality.measure(docs), "pipeline-quality")
    kept = quality.judge(measured, table(spark, sf_dir, "labels"), "doc_id", "lang").where("kept")
    return kept.select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    docs = docs.select(*COLUMNS)
    kept = near_duplicates(docs, "doc_id", percent=NEAR_PERCENT).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    out = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    # rows that repeat a document whole; the join has dealt them by id already
    again = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang")
    return out.withColumn("copy", F.row_number().over(again)).where("copy = 1").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur elsewhere are cut out, whole characters at a time."""
    docs = docs.select(*COLUMNS)
    out = remove_repeats(docs, "doc_id", carry=["doc_id", "lang", "source"], whole_characters=True)
    out = out.withColumn("text", F.decode("kept", "utf-8")).withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark phrases are cut out of the texts."""
    out = decontaminate(docs.select(*COLUMNS), "text", table(spark, sf_dir, "benchmark"))
    out = remove_spans(out)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents and their places in sequences of 4096."""
    cut = packing.pieces(docs, "doc_id", "text", vocabulary())
    narrow = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(staged(narrow, "pipeline-pieces"), ["doc_id", "piece"])


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]
#: Byte-pair tokens and the packing itself cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for i, (_, stage) in enumerate(STAGES[:-1]):
        path = scratch_path(spark, f"pipeline-stage-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
