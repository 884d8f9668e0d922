"""Query of the token-count rollup."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.llm.common import scratch_path, slices, staged, table, texts_of
from tabrix.llm.q_packing import vocabulary
from tabrix.llm.rollup import Rollup, signed
from tabrix.operators.keyed import join_unique

BPE, WORDS = "word_bpe_49k", "words-1"


def token_counts(docs: DataFrame, vocab: str) -> DataFrame:
    """(doc_id, source, lang, bpe, words, blanks, text_id): counts of each whole text.

    ``blanks`` is the rough count that a first pass over a text gives: its blanks plus one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tabrix.llm.tokens import UnitEncoder

        encoder = UnitEncoder.of(vocab)
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in slices([len(t) for t in texts], 8 << 20):
                part = texts[a:b]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in ("doc_id", "source", "lang", "text_id")),
                     pa.array([len(x) for x in encoder.encode(part)], pa.int64()),
                     pa.array([len(t.split()) for t in part], pa.int64()),
                     pa.array([t.count(b" ") + 1 for t in part], pa.int64())],
                    names=["doc_id", "source", "lang", "text_id", "bpe", "words", "blanks"])

    rows = docs.select("doc_id", "source", "lang", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_id"), "text")
    return rows.mapInArrow(count, "doc_id bigint, source string, lang string, text_id string, bpe bigint, words bigint, blanks bigint")


def _changes(rows: DataFrame, op: str, version: str, tokens: Column, old: Column | None = None) -> DataFrame:
    return rows.select(F.lit(op).alias("op"), "source", "lang", F.lit(version).alias("version"), tokens.alias("tokens"),
                       (F.lit(None).cast("long") if old is None else old).alias("old_tokens"))


def op6_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of ``documents`` after a rough first load, a later tokenizer, a revision and a removal of copies.

    The removal is sent twice, as after a lost acknowledgement; it counts once.
    """
    counts = staged(token_counts(table(spark, sf_dir, "documents"), vocabulary()), "token-counts")
    first = counts.groupBy("text_id").agg(F.min("doc_id").alias("first"))
    copies = join_unique(counts, first, ["text_id"]).where(F.col("doc_id") > F.col("first"))
    gone = _changes(copies, "delete", WORDS, F.col("words")).unionByName(_changes(copies, "delete", BPE, F.col("bpe")))
    # three batches to a base, so that the totals come from a base and later deltas
    rollup = Rollup(spark, scratch_path(spark, "rollup"), fold=3)
    rollup.commit("load", signed(_changes(counts, "insert", WORDS, F.col("blanks"))))
    rollup.commit("tokenize", signed(_changes(counts, "insert", BPE, F.col("bpe"))))
    rollup.commit("recount", signed(_changes(counts.where("words != blanks"), "revise", WORDS, F.col("words"), F.col("blanks"))))
    for _ in range(2):
        rollup.commit("copies", signed(gone))
    return rollup.totals()
