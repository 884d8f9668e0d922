"""Registered split, sampling and evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.operators import evaluate as EV
from tabrix.operators import split as S
from tabrix.plans.common import r6, table
from tabrix.plans.registry import ORACLE_SQL, query


def _alloc_sql(src: str, cls: str, p: float) -> str:
    return f"""
c AS (SELECT {cls} AS cls, count(*) AS n_c FROM {src} GROUP BY {cls}),
t AS (SELECT CAST(ceil(sum(n_c) * {p}) AS BIGINT) AS n_test, sum(floor(n_c * {p})) AS n_base FROM c),
r AS (SELECT cls, floor(n_c * {p}) AS base,
             row_number() OVER (ORDER BY n_c * {p} - floor(n_c * {p}) DESC, cls) AS rr FROM c),
alloc AS (SELECT cls, base + CASE WHEN rr <= (SELECT n_test - n_base FROM t) THEN 1 ELSE 0 END AS k
          FROM r)"""


@query("split_customers", sql=f"""
WITH {_alloc_sql('customer', 'c_mktsegment', 0.25)},
ranked AS (SELECT c_custkey, c_mktsegment,
                  row_number() OVER (PARTITION BY c_mktsegment
                                     ORDER BY md5('42:' || c_custkey), c_custkey) AS pos
           FROM customer)
SELECT c_custkey, c_mktsegment, pos <= k AS is_test
FROM ranked JOIN alloc ON alloc.cls = ranked.c_mktsegment
""")
def split_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return S.stratified_split(c, "c_custkey", "c_mktsegment", 0.25, 42)


@query("split_orders_random", sql="""
WITH t AS (SELECT CAST(ceil(count(*) * 0.2) AS BIGINT) AS k FROM orders),
ranked AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey) AS pos
           FROM orders)
SELECT o_orderkey, pos <= k AS is_test FROM ranked CROSS JOIN t
""")
def split_orders_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return S.random_split(o, "o_orderkey", 0.2, 7)


@query("kfold_labels", sql="""
SELECT doc_id, quality,
       CAST((row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) - 1) % 5
            AS INTEGER) AS fold
FROM labels
""")
def kfold_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return S.stratified_kfold(lab, "doc_id", "quality", 5, 42)


@query("sample_events", sql="""
SELECT event_id, ts, user_id, event_type, round(value, 6) AS value
FROM events ORDER BY md5('42:' || event_id), event_id LIMIT 500
""")
def sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type",
                                              r6("value").alias("value"))
    return S.sample_n(e, 500, "event_id", 42)


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels joined with documents; truth = toxic; score = a fixed function of
    the document length; prediction = score >= 0.5."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("int").alias("label"))
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    score = F.col("n_chars").cast("double") / (F.col("n_chars").cast("double") + F.lit(2000.0))
    return lab.join(doc, "doc_id").select(
        "doc_id", "label", score.alias("score"), (score >= 0.5).cast("int").alias("prediction"))


SCORED_SQL = """
s AS (SELECT l.doc_id, CAST(l.toxic AS INTEGER) AS y,
             CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 2000.0) AS p
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
s2 AS (SELECT doc_id, y, p, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS yhat FROM s),
cnt AS (SELECT count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp,
               count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
               count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn,
               count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn,
               count(*) AS n FROM s2)"""


@query("eval_confusion", sql=f"""
WITH {SCORED_SQL}
SELECT 0 AS actual, 0 AS predicted, tn AS n FROM cnt
UNION ALL SELECT 0, 1, fp FROM cnt
UNION ALL SELECT 1, 0, fn FROM cnt
UNION ALL SELECT 1, 1, tp FROM cnt
""")
def eval_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.confusion(scored_labels(spark, sf_dir), "label", "prediction")


@query("eval_metrics", sql=f"""
WITH {SCORED_SQL},
g AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM s2 GROUP BY p),
w AS (SELECT p, pos, neg,
             coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
             sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp_c,
             sum(neg) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp_c
      FROM g),
m AS (
  SELECT 'accuracy' AS metric, CAST(tp + tn AS DOUBLE) / n AS value FROM cnt
  UNION ALL SELECT 'balanced_accuracy',
     CASE WHEN tp + fn = 0 THEN CAST(tn AS DOUBLE) / (tn + fp)
          WHEN tn + fp = 0 THEN CAST(tp AS DOUBLE) / (tp + fn)
          ELSE (CAST(tp AS DOUBLE) / (tp + fn) + CAST(tn AS DOUBLE) / (tn + fp)) / 2 END FROM cnt
  UNION ALL SELECT 'precision', coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) FROM cnt
  UNION ALL SELECT 'recall', coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) FROM cnt
  UNION ALL SELECT 'f1', coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) FROM cnt
  UNION ALL SELECT 'log_loss', avg(-(y * ln(least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
                                   + (1 - y) * ln(1 - least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16))))
            FROM s2
  UNION ALL SELECT 'auc', sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) FROM w
  UNION ALL SELECT 'pr_auc', sum(pos * tp_c / (tp_c + fp_c)) / sum(pos) FROM w
)
SELECT metric, round(value, 6) AS value FROM m
""")
def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = EV.binary_metrics(scored_labels(spark, sf_dir), "label", "prediction", "score")
    return m.select("metric", r6("value").alias("value"))


@query("eval_classification_report", sql=f"""
WITH {SCORED_SQL},
k AS (SELECT tp, fp, tn, fn, n,
             coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0) AS p0,
             coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0) AS r0,
             coalesce(CAST(2 * tn AS DOUBLE) / nullif(2 * tn + fn + fp, 0), 0) AS f0,
             coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS p1,
             coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS r1,
             coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1,
             tn + fp AS s0, tp + fn AS s1 FROM cnt)
SELECT '0' AS row_name, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score,
       CAST(s0 AS BIGINT) AS support FROM k
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM k
UNION ALL SELECT 'accuracy', NULL, NULL, round(CAST(tp + tn AS DOUBLE) / n, 6), CAST(n AS BIGINT) FROM k
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6),
                 CAST(n AS BIGINT) FROM k
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6),
                 round((f0 * s0 + f1 * s1) / n, 6), CAST(n AS BIGINT) FROM k
""")
def eval_classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = EV.classification_report(scored_labels(spark, sf_dir), "label", "prediction")
    return r.select("row_name", *[r6(c).alias(c) for c in ("precision", "recall", "f1_score")],
                    "support")


@query("eval_metrics_by_lang", sql="""
WITH s AS (SELECT d.lang, CAST(l.toxic AS INTEGER) AS y,
                  CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 2000.0) AS p
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
s2 AS (SELECT lang, y, p, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS yhat FROM s),
cnt AS (SELECT lang, count(*) FILTER (WHERE y = 1 AND yhat = 1) AS tp,
               count(*) FILTER (WHERE y = 0 AND yhat = 1) AS fp,
               count(*) FILTER (WHERE y = 0 AND yhat = 0) AS tn,
               count(*) FILTER (WHERE y = 1 AND yhat = 0) AS fn, count(*) AS n,
               avg(-(y * ln(least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
                     + (1 - y) * ln(1 - least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16)))) AS ll
        FROM s2 GROUP BY lang),
g AS (SELECT lang, p, sum(y) AS pos, sum(1 - y) AS neg FROM s2 GROUP BY lang, p),
w AS (SELECT lang, p, pos, neg,
             coalesce(sum(neg) OVER (PARTITION BY lang ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
             sum(pos) OVER (PARTITION BY lang ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp_c,
             sum(neg) OVER (PARTITION BY lang ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp_c
      FROM g),
m AS (
  SELECT lang, 'accuracy' AS metric, CAST(tp + tn AS DOUBLE) / n AS value FROM cnt
  UNION ALL SELECT lang, 'balanced_accuracy',
     CASE WHEN tp + fn = 0 THEN CAST(tn AS DOUBLE) / (tn + fp)
          WHEN tn + fp = 0 THEN CAST(tp AS DOUBLE) / (tp + fn)
          ELSE (CAST(tp AS DOUBLE) / (tp + fn) + CAST(tn AS DOUBLE) / (tn + fp)) / 2 END FROM cnt
  UNION ALL SELECT lang, 'precision', coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) FROM cnt
  UNION ALL SELECT lang, 'recall', coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) FROM cnt
  UNION ALL SELECT lang, 'f1', coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) FROM cnt
  UNION ALL SELECT lang, 'log_loss', ll FROM cnt
  UNION ALL SELECT lang, 'auc', sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) FROM w GROUP BY lang
  UNION ALL SELECT lang, 'pr_auc', sum(pos * tp_c / (tp_c + fp_c)) / sum(pos) FROM w GROUP BY lang
)
SELECT lang, metric, round(value, 6) AS value FROM m
""")
def eval_metrics_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of ``eval_metrics`` per document language (``by=["lang"]``)."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("int").alias("label"))
    doc = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    score = F.col("n_chars").cast("double") / (F.col("n_chars").cast("double") + F.lit(2000.0))
    scored = lab.join(doc, "doc_id").select("lang", "label", score.alias("score"),
                                            (score >= 0.5).cast("int").alias("prediction"))
    m = EV.binary_metrics(scored, "label", "prediction", "score", by=["lang"])
    return m.select("lang", "metric", r6("value").alias("value"))


@query("eval_run_info", sql=ORACLE_SQL["eval_metrics"].replace(
    "SELECT metric, round(value, 6) AS value FROM m",
    "SELECT 'models:/length/1' AS model_uri, 'run-1' AS run_id, 'dev' AS env, metric, round(value, 6) AS value FROM m"))
def eval_run_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run record of an evaluation, its metrics map in rows."""
    from tabrix.operators import model as M

    m = EV.binary_metrics(scored_labels(spark, sf_dir), "label", "prediction", "score")
    info = M.run_info(m, "models:/length/1", "run-1", "dev")
    return info.select("model_uri", "run_id", "env", F.explode("metrics").alias("metric", "value")).withColumn("value", r6("value"))


@query("score_requests", sql="""
SELECT doc_id, CASE WHEN lang = 'de' THEN 'not a JSON object of the expected types' WHEN lang = 'fr' THEN 'lacks n_chars, source'
                    WHEN source IS NULL THEN 'no value for source' END AS reason,
       CASE WHEN lang NOT IN ('de', 'fr') THEN n_chars END AS n_chars
FROM documents
""")
def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON requests, some cut off or incomplete: parsed, with the reason why one cannot be scored."""
    from pyspark.sql import types as T

    from tabrix.operators import score as SC

    whole = F.to_json(F.struct("doc_id", "lang", "source", "n_chars"), {"ignoreNullFields": "false"})
    raw = table(spark, sf_dir, "documents").select("doc_id", F.when(
        F.col("lang") == "de", F.concat(F.lit('{"doc_id":'), F.col("doc_id"), F.lit(', "lang"'))).when(
        F.col("lang") == "fr", F.to_json(F.struct("doc_id", "lang"))).otherwise(whole).alias("value"))
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
    # the request's own key is carried in the line
    key = F.regexp_extract("request", '"doc_id":([0-9]+)', 1).cast("long").alias("doc_id")
    out = SC.checked_requests(raw.drop("doc_id"), schema, ["lang", "n_chars", "source"], ["source"])
    return out.select(key, "reason", "n_chars")
