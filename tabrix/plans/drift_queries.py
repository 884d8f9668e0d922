"""Registered drift, retrain-signal, promotion-ledger and model-selection queries.

Drift frames: ``events`` split in time (reference = first half of the month,
current = second half); features ``user_id, value`` (numeric) and
``event_type, props`` (categorical); target ``event_type = 'purchase'``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.operators import drift as DR
from tabrix.operators import evaluate as EV
from tabrix.operators import promote as P
from tabrix.operators import split as S
from tabrix.plans.common import r6, table
from tabrix.plans.registry import query
from tabrix.plans.split_eval_queries import scored_labels

CUT = "2024-01-16 00:00:00"


def event_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf_dir, "events").select(
        "ts", "user_id", "value", "event_type", "props",
        (F.col("event_type") == "purchase").cast("int").alias("target"))
    cut = F.lit(CUT).cast("timestamp_ntz")
    return e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut)


def features(spark, sf_dir) -> DataFrame:
    ref, cur = event_frames(spark, sf_dir)
    return DR.feature_drift(ref, cur, "target", exclude=["ts"])


FRAMES_SQL = f"""
e AS (SELECT ts, user_id, value, event_type, props,
             CAST(event_type = 'purchase' AS INTEGER) AS target FROM events),
ref AS (SELECT * FROM e WHERE ts < TIMESTAMP '{CUT}'),
cur AS (SELECT * FROM e WHERE ts >= TIMESTAMP '{CUT}'),
rl AS (SELECT 'event_type' AS feature, coalesce(event_type, 'nan') AS value FROM ref
       UNION ALL SELECT 'props', coalesce(props, 'nan') FROM ref),
cl AS (SELECT 'event_type' AS feature, coalesce(event_type, 'nan') AS value FROM cur
       UNION ALL SELECT 'props', coalesce(props, 'nan') FROM cur),
rd AS (SELECT feature, value, count(*) / (SELECT count(*) FROM ref) AS r FROM rl GROUP BY feature, value),
cd AS (SELECT feature, value, count(*) / (SELECT count(*) FROM cur) AS c FROM cl GROUP BY feature, value),
psi AS (
  SELECT coalesce(rd.feature, cd.feature) AS feature,
         sum((greatest(coalesce(c, 1e-6), 1e-6) - greatest(coalesce(r, 1e-6), 1e-6))
             * ln(greatest(coalesce(c, 1e-6), 1e-6) / greatest(coalesce(r, 1e-6), 1e-6))) AS score
  FROM rd FULL OUTER JOIN cd ON rd.feature = cd.feature AND rd.value = cd.value
  GROUP BY 1),
mm AS (
  SELECT 'user_id' AS feature, (SELECT avg(user_id) FROM ref) AS rm, (SELECT avg(user_id) FROM cur) AS cm
  UNION ALL SELECT 'value', (SELECT avg(value) FROM ref), (SELECT avg(value) FROM cur)),
ms AS (SELECT feature, abs(cm - rm) / CASE WHEN abs(rm) > 1e-6 THEN abs(rm) ELSE 1.0 END AS score FROM mm),
feat AS (
  SELECT feature, 'numeric_mean_shift' AS drift_type, score, 0.2 AS threshold, score > 0.2 AS drifted FROM ms
  UNION ALL
  SELECT feature, 'categorical_psi', score, 0.2, score > 0.2 FROM psi),
dsum AS (
  SELECT count(*) AS n_features, count(*) FILTER (WHERE drifted) AS n_drifted,
         coalesce(count(*) FILTER (WHERE drifted) / count(*), 0.0) AS ratio FROM feat),
conc AS (
  SELECT (SELECT avg(CAST(target AS DOUBLE)) FROM ref) AS rr, (SELECT avg(CAST(target AS DOUBLE)) FROM cur) AS cr)
"""


@query("drift_features", sql=f"""
WITH {FRAMES_SQL}
SELECT feature, drift_type, round(score, 6) AS score, CAST(threshold AS DOUBLE) AS threshold, drifted
FROM feat
""")
def drift_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).select("feature", "drift_type", r6("score").alias("score"),
                                          "threshold", "drifted")


@query("drift_data", sql=f"""
WITH {FRAMES_SQL}
SELECT n_features, n_drifted, round(ratio, 6) AS drifted_feature_ratio,
       CAST(0.3 AS DOUBLE) AS threshold, ratio > 0.3 AS status FROM dsum
""")
def drift_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = DR.data_drift(features(spark, sf_dir), 0.30)
    return d.select("n_features", "n_drifted", r6("drifted_feature_ratio").alias("drifted_feature_ratio"),
                    "threshold", "status")


@query("drift_concept", sql=f"""
WITH {FRAMES_SQL}
SELECT round(rr, 6) AS reference_target_rate, round(cr, 6) AS current_target_rate,
       round(abs(cr - rr), 6) AS delta, CAST(0.05 AS DOUBLE) AS threshold,
       coalesce(abs(cr - rr) > 0.05, false) AS status
FROM conc
""")
def drift_concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = event_frames(spark, sf_dir)
    c = DR.concept_drift(ref, cur, "target", 0.05)
    return c.select(r6("reference_target_rate").alias("reference_target_rate"),
                    r6("current_target_rate").alias("current_target_rate"),
                    r6("delta").alias("delta"), "threshold", "status")


@query("drift_psi_daily", sql=f"""
WITH {FRAMES_SQL},
days AS (SELECT CAST(ts AS DATE) AS day, coalesce(event_type, 'nan') AS value FROM e),
dt AS (SELECT day, count(*) AS t FROM days GROUP BY day),
dd AS (SELECT d.day, d.value, count(*) / any_value(dt.t) AS c FROM days d JOIN dt ON d.day = dt.day
       GROUP BY d.day, d.value),
rt AS (SELECT value, r FROM rd WHERE feature = 'event_type'),
grid AS (SELECT dt.day, v.value FROM dt CROSS JOIN (SELECT value FROM rt UNION SELECT DISTINCT value FROM days) v),
full_ AS (SELECT g.day, g.value, dd.c, rt.r FROM grid g LEFT JOIN dd ON g.day = dd.day AND g.value = dd.value
          LEFT JOIN rt ON g.value = rt.value
          WHERE dd.c IS NOT NULL OR rt.r IS NOT NULL)
SELECT day, 'event_type' AS feature,
       round(sum((greatest(coalesce(c, 1e-6), 1e-6) - greatest(coalesce(r, 1e-6), 1e-6))
                 * ln(greatest(coalesce(c, 1e-6), 1e-6) / greatest(coalesce(r, 1e-6), 1e-6))), 6) AS score,
       CAST(0.2 AS DOUBLE) AS threshold,
       sum((greatest(coalesce(c, 1e-6), 1e-6) - greatest(coalesce(r, 1e-6), 1e-6))
           * ln(greatest(coalesce(c, 1e-6), 1e-6) / greatest(coalesce(r, 1e-6), 1e-6))) > 0.2 AS drifted
FROM full_ GROUP BY day
""")
def drift_psi_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PSI of each day's event mix against the reference half (``by=[day]``)."""
    ref, _ = event_frames(spark, sf_dir)
    cur = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"))
    p = DR.psi(ref, cur, ["event_type"], 0.20, by=["day"])
    return p.select("day", "feature", r6("score").alias("score"), "threshold", "drifted")


@query("drift_mean_shift_yearly", sql="""
WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, o_totalprice, o_custkey FROM orders),
r AS (SELECT avg(o_totalprice) AS rp, avg(o_custkey) AS rc FROM o WHERE o_year = 1995),
c AS (SELECT o_year, avg(o_totalprice) AS cp, avg(o_custkey) AS cc FROM o GROUP BY o_year),
m AS (SELECT o_year, 'o_totalprice' AS feature, rp AS ref_mean, cp AS cur_mean FROM c, r
      UNION ALL SELECT o_year, 'o_custkey', rc, cc FROM c, r),
s AS (SELECT *, abs(cur_mean - ref_mean) / CASE WHEN abs(ref_mean) > 1e-6 THEN abs(ref_mean) ELSE 1.0 END AS sc FROM m)
SELECT o_year, feature, round(ref_mean, 6) AS ref_mean, round(cur_mean, 6) AS cur_mean,
       round(sc, 6) AS score, CAST(0.2 AS DOUBLE) AS threshold, sc > 0.2 AS drifted FROM s
""")
def drift_mean_shift_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("o_year"),
                                              "o_totalprice", "o_custkey")
    m = DR.mean_shift(o.where(F.col("o_year") == 1995), o, ["o_totalprice", "o_custkey"], 0.20,
                      by=["o_year"])
    return m.select("o_year", "feature", r6("ref_mean").alias("ref_mean"),
                    r6("cur_mean").alias("cur_mean"), r6("score").alias("score"), "threshold",
                    "drifted")


def _auc_sql(src: str) -> str:
    return f"""(SELECT sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)) FROM (
      SELECT p, pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING
                                                  AND 1 PRECEDING), 0) AS neg_below
      FROM (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM {src} GROUP BY p)))"""


MODEL_SQL = f"""
sl AS (SELECT l.doc_id, CAST(l.toxic AS INTEGER) AS y,
              CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 2000.0) AS p
       FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS pos,
                  CAST(ceil(count(*) OVER () * 0.5) AS BIGINT) AS k FROM sl),
base_ AS (SELECT * FROM ranked WHERE pos > k),
curr_ AS (SELECT * FROM ranked WHERE pos <= k),
md AS (SELECT {_auc_sql('curr_')} AS cm, {_auc_sql('base_')} AS bm),
mdr AS (SELECT cm, bm, greatest(0.0, (bm - cm) / CASE WHEN abs(bm) > 1e-6 THEN abs(bm) ELSE 1.0 END) AS dr
        FROM md)"""


def model_frames(spark, sf_dir):
    s = S.random_split(scored_labels(spark, sf_dir), "doc_id", 0.5, 42)
    cur = EV.roc_auc(s.where("is_test"), "label", "score").select(
        F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    base = EV.roc_auc(s.where(~F.col("is_test")), "label", "score").select(
        F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    return DR.model_drift(cur, base, "auc", 0.05)


@query("drift_model", sql=f"""
WITH {MODEL_SQL}
SELECT 'auc' AS metric_name, round(cm, 6) AS current_metric, round(bm, 6) AS baseline_metric,
       round(dr, 6) AS relative_drop, CAST(0.05 AS DOUBLE) AS threshold, dr > 0.05 AS status FROM mdr
""")
def drift_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC of the fixed length score on one half of the labelled documents (current)
    against the other half (baseline)."""
    m = model_frames(spark, sf_dir)
    return m.select("metric_name", r6("current_metric").alias("current_metric"),
                    r6("baseline_metric").alias("baseline_metric"),
                    r6("relative_drop").alias("relative_drop"), "threshold", "status")


@query("retrain_signal", sql=f"""
WITH {FRAMES_SQL}, {MODEL_SQL}
SELECT (SELECT ratio > 0.3 FROM dsum) AS data_drift,
       (SELECT coalesce(abs(cr - rr) > 0.05, false) FROM conc) AS concept_drift,
       (SELECT dr > 0.05 FROM mdr) AS model_drift,
       (SELECT ratio > 0.3 FROM dsum) OR (SELECT coalesce(abs(cr - rr) > 0.05, false) FROM conc)
         OR (SELECT dr > 0.05 FROM mdr) AS should_retrain
""")
def retrain_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = event_frames(spark, sf_dir)
    data = DR.data_drift(DR.feature_drift(ref, cur, "target", exclude=["ts"]), 0.30)
    concept = DR.concept_drift(ref, cur, "target", 0.05)
    return DR.retrain_signal(data, concept, model_frames(spark, sf_dir))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a runs table: user -> model, event type -> env, event -> version,
    value -> score, props.k > 90 -> retrain gate."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("model_name"), F.col("event_type").alias("env"),
                    F.col("event_id").alias("version"), F.col("value").alias("score"),
                    (F.get_json_object("props", "$.k").cast("int") > 90).alias("should_retrain"),
                    "ts")


@query("promotion_ledger", sql="""
WITH r AS (SELECT user_id AS model_name, event_type AS env, event_id AS version, value AS score,
                  CAST(json_extract(props, '$.k') AS INTEGER) > 90 AS should_retrain, ts FROM events),
b AS (SELECT *, max(CASE WHEN NOT should_retrain THEN score END) OVER (
                  PARTITION BY model_name, env ORDER BY ts, version
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM r),
p AS (SELECT *, NOT should_retrain AND (best_before IS NULL OR score > best_before) AS promoted FROM b),
c AS (SELECT *, last_value(CASE WHEN promoted THEN version END IGNORE NULLS) OVER (
                  PARTITION BY model_name, env ORDER BY ts, version
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS champion_before FROM p)
SELECT model_name, env, version, round(score, 6) AS score, should_retrain, ts,
       round(best_before, 6) AS best_score_before,
       CASE WHEN should_retrain THEN 'skipped_retrain' WHEN promoted THEN 'promote' ELSE 'keep' END AS decision,
       CASE WHEN promoted THEN version ELSE champion_before END AS champion_after,
       CASE WHEN promoted THEN champion_before ELSE version END AS challenger_after
FROM c
""")
def promotion_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = P.ledger(runs(spark, sf_dir))
    return led.select("model_name", "env", "version", r6("score").alias("score"), "should_retrain",
                      "ts", r6("best_score_before").alias("best_score_before"), "decision",
                      "champion_after", "challenger_after")


@query("select_best", sql="""
WITH s AS (SELECT event_type AS algorithm, user_id AS candidate, round(avg(value), 6) AS cv_score
           FROM events GROUP BY event_type, user_id),
r AS (SELECT *, row_number() OVER (PARTITION BY algorithm ORDER BY cv_score DESC, candidate) AS rn FROM s)
SELECT algorithm, candidate AS best_candidate, cv_score AS best_score FROM r WHERE rn = 1
""")
def select_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best candidate per algorithm by mean score (strictly greater wins, first
    candidate wins ties)."""
    e = table(spark, sf_dir, "events")
    scores = e.groupBy(F.col("event_type").alias("algorithm"), F.col("user_id").alias("candidate")) \
        .agg(r6(F.avg("value")).alias("cv_score"))
    return P.select_best(scores, "algorithm", "candidate", "cv_score")


@query("promotion_current", sql="""
WITH r AS (SELECT user_id AS model_name, event_type AS env, event_id AS version, value AS score,
                  CAST(json_extract(props, '$.k') AS INTEGER) > 90 AS should_retrain, ts FROM events),
b AS (SELECT *, max(CASE WHEN NOT should_retrain THEN score END) OVER (
                  PARTITION BY model_name, env ORDER BY ts, version
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM r),
p AS (SELECT *, NOT should_retrain AND (best_before IS NULL OR score > best_before) AS promoted FROM b),
c AS (SELECT *, last_value(CASE WHEN promoted THEN version END IGNORE NULLS) OVER (
                  PARTITION BY model_name, env ORDER BY ts, version
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS champion_before FROM p),
l AS (SELECT *, CASE WHEN promoted THEN version ELSE champion_before END AS champion_after,
             CASE WHEN promoted THEN champion_before ELSE version END AS challenger_after,
             row_number() OVER (PARTITION BY model_name, env ORDER BY ts DESC, version DESC) AS rn_last,
             row_number() OVER (PARTITION BY model_name, env ORDER BY CASE WHEN promoted THEN 0 ELSE 1 END,
                                ts DESC, version DESC) AS rn_champ
      FROM c)
SELECT l1.model_name, l1.env, l1.champion_after AS champion, l1.challenger_after AS challenger,
       CASE WHEN l2.promoted THEN round(l2.score, 6) END AS champion_score
FROM l l1 JOIN l l2 ON l1.model_name = l2.model_name AND l1.env = l2.env
WHERE l1.rn_last = 1 AND l2.rn_champ = 1
""")
def promotion_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current champion, challenger and champion score (the drift baseline) per
    (model, env) after replaying the whole runs table."""
    cur = P.current_aliases(P.ledger(runs(spark, sf_dir)))
    return cur.select("model_name", "env", "champion", "challenger",
                      r6("champion_score").alias("champion_score"))


@query("drift_model_asof", sql="""
WITH r AS (SELECT user_id AS model_name, event_type AS env, event_id AS version, value AS score,
                  CAST(json_extract(props, '$.k') AS INTEGER) > 90 AS should_retrain, ts FROM events),
b AS (SELECT *, max(CASE WHEN NOT should_retrain THEN score END) OVER (
                  PARTITION BY model_name, env ORDER BY ts, version
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM r),
p AS (SELECT *, NOT should_retrain AND (best_before IS NULL OR score > best_before) AS promoted FROM b),
champions AS (SELECT model_name, env, ts, max(version) AS version, max(score) AS score FROM p WHERE promoted GROUP BY model_name, env, ts),
j AS (SELECT r.model_name, r.env, r.version, r.ts + INTERVAL 6 HOUR AS evaluated_at, r.score AS value,
             c.version AS baseline_version, c.score AS baseline
      FROM r ASOF LEFT JOIN champions c ON r.model_name = c.model_name AND r.env = c.env AND r.ts + INTERVAL 6 HOUR >= c.ts),
d AS (SELECT *, CASE WHEN baseline IS NULL THEN 0.0
             ELSE greatest(0.0, (baseline - value) / CASE WHEN abs(baseline) > 1e-6 THEN abs(baseline) ELSE 1.0 END) END AS drop_ FROM j)
SELECT model_name, env, version, evaluated_at, round(value, 6) AS value, baseline_version, round(baseline, 6) AS baseline_metric,
       round(drop_, 6) AS relative_drop, CAST(0.05 AS DOUBLE) AS threshold, drop_ > 0.05 AS status FROM d
""")
def drift_model_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run evaluated again six hours later, against the champion of that time."""
    all_runs = runs(spark, sf_dir)
    later = all_runs.select("model_name", "env", "version", (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("evaluated_at"),
                            F.col("score").alias("value"))
    history = DR.champion_history(P.ledger(all_runs)).withColumnRenamed("ts", "evaluated_at")
    out = DR.model_drift_asof(later, history, ts="evaluated_at")
    return out.select("model_name", "env", "version", "evaluated_at", r6("value").alias("value"), "baseline_version",
                      r6("baseline_metric").alias("baseline_metric"), r6("relative_drop").alias("relative_drop"), "threshold", "status")
