"""Query of the quality rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabrix.llm import quality
from tabrix.llm.common import staged, table


def op9_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = staged(quality.measure(docs).drop("text"), "quality-measures")
    out = quality.judge(measured, table(spark, sf_dir, "labels"), "doc_id", "lang")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def _first_step(rule: int, value: str, cutoffs: tuple[float, ...]) -> str:
    """The first step of the path at which ``value`` is above the rule's cutoff."""
    levels = " ".join(f"WHEN {value} > {c} THEN {i * len(quality.RULES) + rule}" for i, c in enumerate(cutoffs))
    return f"CASE {levels} END"


_VALUES = {"symbols_per_word": "n_symbols / greatest(n_words, 1)", "shouts_per_word": "n_shouts / greatest(n_words, 1)",
           "dup_line_share": "n_dup_lines / greatest(n_lines, 1)"}
_STEP = ", ".join(_first_step(i, _VALUES[name], cuts) for i, (name, cuts) in enumerate(quality.RULES.items()))
_RISK = quality.Risk()

OP9_SQL = f"""
WITH t AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM t)
), again AS (
  SELECT doc_id, unnest(starts) AS i FROM (SELECT doc_id, list(i) AS starts FROM windows GROUP BY doc_id, g HAVING count(*) > 1)
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id
), m AS (
  SELECT t.doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(regexp_extract_all(text, '!')) AS n_shouts,
         len(ls) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM t LEFT JOIN repeated r ON r.doc_id = t.doc_id
), f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
), p AS (
  SELECT *, CASE WHEN NOT base_failed THEN least({_STEP}) END AS step FROM f
), seen AS (
  SELECT lang, coalesce(step, 1048576) AS step, count(*) AS c FROM p
  WHERE doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1) GROUP BY ALL
), counted AS (
  SELECT lang, step, sum(c) OVER (PARTITION BY lang) AS n, sum(c) OVER (PARTITION BY lang ORDER BY step) AS k
  FROM (SELECT * FROM seen UNION ALL SELECT DISTINCT lang, -1, 0 FROM seen)
), tested AS (
  SELECT lang, step, k >= n * {_RISK.alpha} OR list_sum(list_transform(range(0, CAST(k AS BIGINT) + 1),
           lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({_RISK.alpha}) + (n - i) * ln({1 - _RISK.alpha}))))
         > {_RISK.delta} / (SELECT count(*) FROM (SELECT DISTINCT lang FROM seen)) AS failed
  FROM counted
), cuts AS (
  SELECT lang, coalesce(min(step) FILTER (WHERE failed) - 1, 1048575) AS last_step FROM tested GROUP BY lang
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR coalesce(step <= last_step, false)) AS kept
FROM p LEFT JOIN cuts ON cuts.lang IS NOT DISTINCT FROM p.lang
"""
