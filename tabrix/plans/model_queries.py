"""Registered resampling, training and scoring queries.

Training data: ``labels`` joined with ``documents``; target ``quality``;
features ``n_chars`` (numeric), ``lang``, ``source`` (categorical) and the
document text (TF-IDF). Model queries have no SQL oracle (rows-only check).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.operators import model as M
from tabrix.operators.features import with_terms
from tabrix.operators import resample as R
from tabrix.operators import score as SC
from tabrix.operators import split as S
from tabrix.plans.common import table
from tabrix.plans.registry import query
from tabrix.session import materialize

NUMERIC = ["n_chars"]
CATEGORICAL = ["lang", "source"]
TEXT = "text"
EXPECTED = NUMERIC + CATEGORICAL + ["text_terms"]


@query("oversample_labels", sql="""
WITH c AS (SELECT toxic, count(*) AS n FROM labels GROUP BY toxic),
m AS (SELECT max(n) AS n_max FROM c),
r AS (SELECT doc_id, toxic,
             row_number() OVER (PARTITION BY toxic ORDER BY md5('42:' || doc_id), doc_id) AS pos
      FROM labels),
k AS (SELECT r.doc_id, r.toxic,
             CAST(floor((m.n_max - c.n) / c.n)
                  + CASE WHEN r.pos <= (m.n_max - c.n) % c.n THEN 1 ELSE 0 END AS BIGINT) AS copies
      FROM r JOIN c ON r.toxic = c.toxic CROSS JOIN m)
SELECT doc_id, toxic, CAST(0 AS BIGINT) AS copy_id FROM labels
UNION ALL
SELECT doc_id, toxic, CAST(unnest(range(1, copies + 1)) AS BIGINT) AS copy_id FROM k WHERE copies > 0
""")
def oversample_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return R.oversample_repeat(lab, "toxic", "doc_id", 42)


NOMINAL = ["lang", "source", "size_class"]
_SIZE_CLASS = "CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 2000 THEN 'middle' ELSE 'long' END"


@query("oversample_neighbours", sql=f"""
WITH d AS (SELECT l.doc_id, l.toxic, d.lang, d.source, {_SIZE_CLASS} AS size_class
           FROM labels l JOIN documents d USING (doc_id)),
cls AS (SELECT toxic, count(*) AS n_c FROM d GROUP BY toxic),
long AS (SELECT doc_id, toxic, 0 AS f, 'lang' AS col, lang AS v FROM d
         UNION ALL SELECT doc_id, toxic, 1, 'source', source FROM d
         UNION ALL SELECT doc_id, toxic, 2, 'size_class', size_class FROM d),
seen AS (SELECT col, v, toxic, count(*) AS c FROM long GROUP BY ALL),
share AS (SELECT x.col, x.v, cls.toxic, CAST(floor(coalesce(s.c, 0) * 1000000 / x.n) AS BIGINT) AS p
          FROM (SELECT col, v, sum(c) AS n FROM seen GROUP BY ALL) x CROSS JOIN cls
          LEFT JOIN seen s ON s.col = x.col AND s.v = x.v AND s.toxic = cls.toxic),
dirs AS (SELECT unnest(range(4)) AS pr),
place AS (SELECT l.doc_id, l.toxic, pr, md5('42:' || l.doc_id) AS h,
                 sum(s.p * (CAST('0x' || substr(md5(pr || ':' || l.col || ':=' || s.toxic), 1, 7) AS BIGINT) % 2001 - 1000)) AS spot
          FROM long l JOIN share s ON s.col = l.col AND s.v = l.v CROSS JOIN dirs
          GROUP BY l.doc_id, l.toxic, pr),
ranked AS (SELECT *, row_number() OVER (PARTITION BY toxic, pr ORDER BY spot, h, doc_id) AS pos FROM place),
met AS (SELECT DISTINCT a.doc_id, b.doc_id AS other, b.h
        FROM ranked a JOIN ranked b ON a.toxic = b.toxic AND a.pr = b.pr AND a.pos <> b.pos AND abs(a.pos - b.pos) <= 10),
apart AS (SELECT m.doc_id, m.other, m.h, la.f, la.col, la.v AS va, lb.v AS vb
          FROM met m JOIN long la ON la.doc_id = m.doc_id JOIN long lb ON lb.doc_id = m.other AND lb.f = la.f),
col_diff AS (SELECT q.col, va, vb, sum(abs(x.p - y.p)) AS delta
             FROM (SELECT DISTINCT col, va, vb FROM apart) q
             JOIN share x ON x.col = q.col AND x.v = q.va
             JOIN share y ON y.col = q.col AND y.v = q.vb AND y.toxic = x.toxic
             GROUP BY q.col, va, vb),
dist AS (SELECT doc_id, other, h, sum(delta * delta) AS d
         FROM apart JOIN col_diff USING (col, va, vb) GROUP BY doc_id, other, h),
near AS (SELECT doc_id, other FROM dist QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d, h, other) <= 5),
votes AS (SELECT n.doc_id, l.col, l.v, count(*) AS c FROM near n JOIN long l ON l.doc_id = n.other GROUP BY ALL),
modes AS (SELECT doc_id, max(v) FILTER (WHERE col = 'lang') AS lang, max(v) FILTER (WHERE col = 'source') AS source,
                 max(v) FILTER (WHERE col = 'size_class') AS size_class
          FROM (SELECT * FROM votes QUALIFY row_number() OVER (PARTITION BY doc_id, col ORDER BY c DESC, v) = 1) GROUP BY doc_id),
m AS (SELECT max(n_c) AS n_max FROM cls),
r AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5('42:' || doc_id), doc_id) AS pos FROM d),
k AS (SELECT r.doc_id, r.toxic,
             CAST(floor((n_max - n_c) / n_c) + CASE WHEN pos <= (n_max - n_c) % n_c THEN 1 ELSE 0 END AS BIGINT) AS copies
      FROM r JOIN cls USING (toxic) CROSS JOIN m)
SELECT doc_id, toxic, lang, source, size_class, CAST(0 AS BIGINT) AS copy_id FROM d
UNION ALL
SELECT k.doc_id, k.toxic, modes.lang, modes.source, modes.size_class, CAST(unnest(range(1, copies + 1)) AS BIGINT)
FROM k JOIN modes ON modes.doc_id = k.doc_id WHERE copies > 0
""")
def oversample_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents, the toxic class raised by rows made from its nearest neighbours."""
    doc = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.expr(_SIZE_CLASS).alias("size_class"))
    lab = table(spark, sf_dir, "labels").select("doc_id", "toxic").join(doc, "doc_id")
    return R.oversample_neighbours(materialize(lab), "toxic", "doc_id", NOMINAL)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and label alone: what splits and folds rank."""
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))


def with_features(keys: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """``keys`` with the documents' features and uni+bigram terms (stateless); the raw text is dropped."""
    doc = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double"),
                                                   "lang", "source", "text")
    return with_terms(keys.join(doc, "doc_id"), TEXT, "text_terms").drop(TEXT)


def _pipeline(params=None):
    return M.build_pipeline(NUMERIC, CATEGORICAL, TEXT, "logistic_regression",
                            params or {"maxIter": 30}, scaler="standard",
                            text_terms="text_terms")


@query("model_search")
def model_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random search over the regularisation grid with 5 exact stratified folds."""
    train, _ = S.split_frames(labelled(spark, sf_dir), "doc_id", "label", 0.25, 42)
    folds = S.stratified_kfold(train, "doc_id", "label", 5, 42, out="fold")
    # 20 fold fits + refit read the training frame: materialise it once
    folds = materialize(with_features(folds, spark, sf_dir))
    cv, maps = M.search(folds, _pipeline(), {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
                        fold_col="fold", n_iter=4, seed=42, parallelism=4,
                        num_folds=5)
    return M.search_summary(spark, cv, maps, "logistic_regression")


@query("train_score")
def train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the stratified train split, score the held-out split (class, P(1))."""
    flagged = S.stratified_split(labelled(spark, sf_dir), "doc_id", "label", 0.25, 42, "is_test")
    flagged = materialize(with_features(flagged, spark, sf_dir))
    train, test = flagged.where(~F.col("is_test")), flagged.where(F.col("is_test"))
    model = _pipeline({"maxIter": 30, "regParam": 0.1}).fit(train)
    scored = SC.score_batch(model, test, EXPECTED, keep=["doc_id", "label"])
    return scored.select("doc_id", F.col("label").cast("int").alias("label"), "prediction",
                         "probability")


CANDIDATES = (
    M.Candidate("logistic_regression", {"maxIter": 20}, {"regParam": [0.01, 0.1]}, ("none", "standard", "robust")),
    M.Candidate("random_forest", {"numTrees": 20}, {"maxDepth": [4, 6]}),
    M.Candidate("gbt", {"maxIter": 10, "stepSize": 0.2}, {"maxDepth": [2, 3]}),
)


def _candidates(spark: SparkSession, sf_dir: str) -> M.CandidateSearch:
    train, _ = S.split_frames(labelled(spark, sf_dir), "doc_id", "label", 0.25, 42)
    folds = S.stratified_kfold(materialize(train), "doc_id", "label", 3, 42, out="fold")
    folds = materialize(with_features(folds, spark, sf_dir))
    stages = M.feature_stages(NUMERIC, CATEGORICAL, TEXT, 200, "text_terms")
    return M.search_candidates(folds, CANDIDATES, stages, key="doc_id", num_folds=3, n_iter=2, parallelism=4)


@query("model_candidates")
def model_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of learners, scalers and parameters per fold, and the selected one."""
    return _candidates(spark, sf_dir).scores


@query("model_candidates_folds", sql="""
WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) AS pos FROM labels),
c AS (SELECT quality, count(*) AS n_c FROM labels GROUP BY quality),
t AS (SELECT CAST(ceil(sum(n_c) * 0.25) AS BIGINT) AS n_test, sum(floor(n_c * 0.25)) AS n_base FROM c),
a AS (SELECT quality, floor(n_c * 0.25) + CASE WHEN row_number() OVER (ORDER BY n_c * 0.25 - floor(n_c * 0.25) DESC, quality)
             <= (SELECT n_test - n_base FROM t) THEN 1 ELSE 0 END AS k FROM c),
train AS (SELECT doc_id, quality FROM r JOIN a USING (quality) WHERE pos > k),
f AS (SELECT doc_id, (row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) - 1) % 3 AS fold FROM train)
SELECT CAST(fold AS INTEGER) AS fold, (SELECT count(*) FROM f) - count(*) AS n_fit, count(*) AS n_held,
       CAST(sum(doc_id) AS BIGINT) AS held_key_sum, 6 AS n_candidates, 1 AS n_selected, true AS selected_is_first_best
FROM f GROUP BY fold
""")
def model_candidates_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can check of the search: the rows of each fold, and that the first of the best candidates is selected."""
    found = _candidates(spark, sf_dir)
    first_best = F.min(F.struct((-F.col("mean_auc")).alias("neg"), "candidate"))["candidate"]
    chosen = F.max(F.when(F.col("selected"), F.col("candidate")))
    told = found.scores.agg(F.count_distinct("candidate").cast("int").alias("n_candidates"),
                            F.count_distinct(F.when(F.col("selected"), F.col("candidate"))).cast("int").alias("n_selected"),
                            (chosen == first_best).alias("selected_is_first_best")).first()
    return found.folds.select("*", *[F.lit(told[c]).alias(c) for c in ("n_candidates", "n_selected", "selected_is_first_best")])


@query("tree_learners", sql="""
WITH c AS (SELECT quality, count(*) AS n_c FROM labels GROUP BY quality),
t AS (SELECT CAST(ceil(sum(n_c) * 0.25) AS BIGINT) AS n_test FROM c)
SELECT algorithm, n_test AS n_scored, true AS reload_equal, true AS importances_sum_to_one, true AS fits_training_rows
FROM t, (SELECT unnest(['gbt', 'random_forest']) AS algorithm)
""")
def tree_learners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees and a forest: saved and loaded models score alike, importances sum to one, training rows are told apart."""
    from tabrix.operators import evaluate as EV
    from tabrix.session import scratch_path
    from tabrix.sources import io as IO

    flagged = materialize(with_features(S.stratified_split(labelled(spark, sf_dir), "doc_id", "label", 0.25, 42, "is_test"), spark, sf_dir))
    train, test = flagged.where(~F.col("is_test")), flagged.where(F.col("is_test"))
    out = None
    for algorithm, params in (("gbt", {"maxIter": 10, "maxDepth": 3}), ("random_forest", {"numTrees": 20, "maxDepth": 6})):
        model = M.build_pipeline(NUMERIC, CATEGORICAL, TEXT, algorithm, params, tfidf_max_features=200, text_terms="text_terms").fit(train)
        path = scratch_path(spark, f"model-{algorithm}")
        IO.save_model(model, path)
        scored = SC.score_batch(model, test, EXPECTED, keep=["doc_id", "label"])
        again = SC.score_batch(IO.load_model(path), test, EXPECTED, keep=["doc_id"])
        scored = materialize(scored.join(again.select("doc_id", F.col("probability").alias("again")), "doc_id"))
        fitted = materialize(M.predict(model, train, ["label"]).withColumn("label", F.col("label").cast("int")))
        auc = EV.roc_auc(fitted, "label", "probability")
        total = M.feature_importances(model).agg(F.sum("importance")).first()[0]
        row = scored.agg(F.count(F.lit(1)).alias("n_scored"), F.bool_and(F.col("probability") == F.col("again")).alias("reload_equal")).select(
            F.lit(algorithm).alias("algorithm"), "n_scored", "reload_equal", F.lit(abs(total - 1) < 1e-9).alias("importances_sum_to_one"),
            F.lit(auc.first()["auc"] > 0.75).alias("fits_training_rows"))
        out = row if out is None else out.unionByName(row)
    return out
