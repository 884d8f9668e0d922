"""Pipeline stages against plain Python, saved and loaded; search over learners and scalers."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabrix.operators import features as FE
from tabrix.operators import model as M
from tabrix.operators import split as S
from tabrix.operators import stages as ST


def vectors(df, col):
    return [r[0] for r in df.orderBy("id").select(vector_to_array(col)).collect()]


@pytest.mark.parametrize("near", [1000, 3])
def test_categories_of_any_number(spark, monkeypatch, tmp_path, near):
    monkeypatch.setattr(ST, "NEAR", near)
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot", "hot", "hot", f"v{rng.randint(0, 9)}", "", None]), rng.choice([1, 2]), f"k{i % 40}") for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, c string, n int, many string")
    model = Pipeline(stages=FE.one_hot_stages(["c", "n", "many"])).fit(df)
    more = [*rows, (1000, "new", 9, None), (1001, None, None, "k3")]
    model.write().overwrite().save(str(tmp_path / "m"))
    names = [sorted({str(r[i]) for r in rows if r[i] is not None}) for i in (1, 2, 3)]
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        out = m.transform(spark.createDataFrame(more, df.schema))
        assert out.count() == len(more)
        for i, c in ((0, "c"), (1, "n"), (2, "many")):
            want = [[float(v is not None and str(v) == x) for x in names[i]] for v in (r[i + 1] for r in more)]
            assert vectors(out, f"{c}_ohe") == want
    empty = spark.createDataFrame([(1, None)], "id bigint, c string")
    assert vectors(Pipeline(stages=FE.one_hot_stages(["c"])).fit(empty).transform(empty), "c_ohe") == [[0.0]]


def test_only_sizes_reach_the_driver_and_hot_values_stay(spark):
    df = spark.range(20_000).select("id", F.concat(F.lit("v"), F.col("id")).alias("c"))
    stage = FE.one_hot_stages(["c"])[0].fit(df)
    assert stage.stages[0].getOrDefault("sizes") == [20_000]
    few = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("c"))
    plan = FE.one_hot_stages(["c"])[0].fit(few).transform(few)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_robust_scale_of_sparse_rows(spark):
    rng = random.Random(4)
    d = 6
    dense = [[0.0 if rng.random() < (0.1, 0.6, 0.9, 0.97, 0.0, 1.0)[j] else rng.choice([-3.0, -1.5, 0.25, 2.0, 7.0]) if j != 4 else 5.0
              for j in range(d)] for _ in range(301)]
    rows = [(i, Vectors.sparse(d, [(j, x) for j, x in enumerate(v) if x]) if i % 2 else Vectors.dense(v)) for i, v in enumerate(dense)]
    df = spark.createDataFrame(rows, ["id", "v"])
    got = np.array(vectors(M.scaler_stage("robust", "v", "f").fit(df).transform(df), "f"))
    x = np.array(dense)
    q1, med, q3 = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    scale = np.where(q3 - q1 == 0, 1, q3 - q1)
    assert np.allclose(got, (x - med) / scale)


@pytest.mark.parametrize("kind", ["standard", "minmax", "robust"])
def test_stage_equals_the_long_form_with_constants(spark, tmp_path, kind):
    rng = random.Random(5)
    df = spark.createDataFrame([(i, rng.gauss(0, 3), 4.0, 0.0, float(rng.randint(0, 2))) for i in range(120)],
                               "id bigint, a double, same double, zero double, few double")
    cols = ["a", "same", "zero", "few"]
    want = [tuple(r)[1:] for r in FE.scale(df, cols, kind).orderBy("id").collect()]
    pipe = Pipeline(stages=[FE.assemble(cols, "v"), M.scaler_stage(kind, "v", "f")])
    pipe.write().overwrite().save(str(tmp_path / "p"))
    for p in (pipe, Pipeline.load(str(tmp_path / "p"))):
        assert np.allclose(vectors(p.fit(df).transform(df), "f"), want)


def test_scales_without_centres_keep_rows_sparse(spark):
    df = spark.createDataFrame([(i, Vectors.sparse(5, [(i % 5, 1.0 + i)])) for i in range(20)], ["id", "v"])
    for kind in ("standard", "minmax", "robust"):
        out = M.scaler_stage(kind, "v", "f").fit(df).transform(df)
        assert {r[0] for r in out.select(F.unwrap_udt("f")["type"]).collect()} == {0}


def test_texts_are_read_once(spark):
    df = spark.createDataFrame([(i, f"common word{i % 7} text") for i in range(50)], "id bigint, t string")
    out = FE.tfidf(df, "id", "t", max_features=9)
    assert "regexp_extract_all" not in out._jdf.queryExecution().optimizedPlan().toString()
    vocab = FE.fit_tfidf(df, "id", "t", max_features=9)
    assert out.exceptAll(FE.tfidf_long(df, "id", "t", vocab)).count() == 0 and out.count() > 50


def test_document_terms_count_inside_the_row(spark):
    df = spark.createDataFrame([(1, "b b a b"), (2, ""), (3, None), (3, "aa bb aa bb")], "id bigint, t string")
    got = sorted((r["id"], [tuple(t) for t in r["terms"]]) for r in FE.document_terms(df, "id", "t").collect())
    assert got == [(1, []), (2, []), (3, []), (3, [("aa", 2), ("aa bb", 2), ("bb", 2), ("bb aa", 1)])]


def train_rows(spark):
    rng = random.Random(1)
    rows = [(i, float(rng.random() + (i % 2) * 0.6), rng.choice("abc"), float(i % 2)) for i in range(240)]
    df = spark.createDataFrame(rows, "id bigint, x double, c string, label double")
    return S.stratified_kfold(df, "id", "label", 3, out="fold").cache()


def test_candidates_equal_the_search_of_one_learner(spark):
    df = train_rows(spark)
    features = M.feature_stages(["x"], ["c"], None)
    found = M.search_candidates(df, [M.Candidate("logistic_regression", {"maxIter": 5}, {"regParam": [0.0, 0.1]}, ("standard",)),
                                     M.Candidate("gbt", {"maxIter": 3, "maxDepth": 2}), M.Candidate("random_forest", {"numTrees": 5})],
                                features, key="id", num_folds=3)
    pipe = M.build_pipeline(["x"], ["c"], None, "logistic_regression", {"maxIter": 5}, scaler="standard")
    cv, _ = M.search(df, pipe, {"regParam": [0.0, 0.1]}, num_folds=3)
    rows = found.scores.collect()
    mean = {r["candidate"]: r["mean_auc"] for r in rows}
    assert [round(mean[i], 9) for i in (0, 1)] == [round(x, 9) for x in cv.avgMetrics]
    assert {r["algorithm"] for r in rows} == {"logistic_regression", "gbt", "random_forest"} and len(rows) == 12
    best = {r["candidate"] for r in rows if r["selected"]}
    assert best == {min(i for i in mean if mean[i] == max(mean.values()))}
    folds = {r["fold"]: (r["n_fit"], r["n_held"], r["held_key_sum"]) for r in found.folds.collect()}
    want = {r["fold"]: (240 - r["n"], r["n"], r["s"]) for r in df.groupBy("fold").agg(F.count("*").alias("n"), F.sum("id").alias("s")).collect()}
    assert folds == want
    assert M.predict(found.model, df, ["id"]).count() == 240


def test_ties_go_to_the_first_and_draws_are_seeded(spark):
    df = train_rows(spark)
    same = M.Candidate("logistic_regression", {"maxIter": 5}, {"tol": [1e-6, 1e-6]})
    found = M.search_candidates(df, [same], M.feature_stages(["x"], [], None), num_folds=3)
    assert {r["candidate"] for r in found.scores.where("selected").collect()} == {0}
    many = M.Candidate("gbt", {}, {"maxDepth": [1, 2, 3], "stepSize": [0.1, 0.2]}, ("none", "robust"))
    assert len(many.draws(None, 1)) == 12 and many.draws(5, 7) == many.draws(5, 7) and len(many.draws(5, 7)) == 5
    with pytest.raises(ValueError):
        M.search_candidates(df, [], M.feature_stages(["x"], [], None))


def test_tree_learners_reload_and_rank(spark, tmp_path):
    df = train_rows(spark)
    for algorithm, params in (("gbt", {"maxIter": 5}), ("random_forest", {"numTrees": 5})):
        model = M.build_pipeline(["x"], ["c"], None, algorithm, params).fit(df)
        model.write().overwrite().save(str(tmp_path / algorithm))
        again = PipelineModel.load(str(tmp_path / algorithm))
        a = [tuple(r) for r in M.predict(model, df, ["id"]).orderBy("id").collect()]
        assert a == [tuple(r) for r in M.predict(again, df, ["id"]).orderBy("id").collect()]
        assert abs(M.feature_importances(model).agg(F.sum("importance")).first()[0] - 1) < 1e-9
        held = M.build_pipeline(["x"], ["c"], None, algorithm, params).fit(df.where("fold != 0"))
        a = [tuple(r) for r in M.predict(held, df.where("fold = 0"), ["label"]).collect()]
        auc = sum((p[2] > q[2]) + 0.5 * (p[2] == q[2]) for p in a if p[0] == 1 for q in a if q[0] == 0) / (len(a) / 2) ** 2
        assert auc > 0.8
    with pytest.raises(ValueError):
        M.feature_importances(M.build_pipeline(["x"], [], None, "logistic_regression").fit(df))


def fold_rows(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", None, f"z{i}"]), [rng.choice(["x", "y", "z", f"t{i % 40}", None]) for _ in range(rng.randrange(6))] if i % 9 else None,
             rng.choice([0, 1, 2, 7, None]), float(i % 2), float(rng.random() + (i % 2) * 0.6)) for i in range(200)]
    return spark.createDataFrame(rows, "id bigint, c string, terms array<string>, fold int, label double, x double")


def test_fold_models_equal_fits_on_the_rows_outside(spark):
    df = fold_rows(spark)
    outside = [df.where(F.col("fold") != k) for k in range(3)] + [df]
    for stage in (ST.CategoryStage(inputCols=["c"], outputCols=["v"]), ST.TfidfStage(inputCol="terms", outputCol="v", maxFeatures=12, minDF=2, maxDF=0.5)):
        models = stage.fold_models(df, "fold", 3)
        assert len(models) == 4
        for model, rows in zip(models, outside, strict=True):
            got, want = (m.transform(df.where("terms IS NOT NULL")).select("id", "v").orderBy("id").collect() for m in (model, stage.fit(rows)))
            assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_searches_count_categories_and_terms_once(spark, monkeypatch):
    df = fold_rows(spark).where("fold < 3 AND terms IS NOT NULL").cache()
    pipe = M.build_pipeline(["x"], ["c"], "terms", "logistic_regression", {"maxIter": 3}, tfidf_max_features=5, text_terms="terms")
    features = M.feature_stages(["x"], ["c"], "terms", 5, "terms")
    one = M.Candidate("logistic_regression", {"maxIter": 3, "regParam": 0.1})
    plain = pipe.fit(df).transform(df).select("id", "features").orderBy("id").collect()

    def again(self, rows):
        raise AssertionError("fitted once more")

    monkeypatch.setattr(ST.CategoryStage, "_fit", again)
    monkeypatch.setattr(ST.TfidfStage, "_fit", again)
    cv, _ = M.search(df, pipe, {"regParam": [0.1]}, num_folds=3)
    found = M.search_candidates(df, [one], features, num_folds=3)
    assert cv.bestModel.transform(df).select("id", "features").orderBy("id").collect() == plain
    assert found.model.transform(df).select("id", "features").orderBy("id").collect() == plain
    assert abs(found.scores.first()["mean_auc"] - cv.avgMetrics[0]) < 1e-9
