"""MLlib training and model selection.

* ``build_pipeline``: one-hot for categoricals, TF-IDF for the text column,
  numeric passthrough, ``VectorAssembler``, optional scaler, classifier. The
  whole pipeline is the estimator, so encoders are refitted inside each fold.
* ``search``: seeded draw (without replacement) of ``n_iter`` parameter maps
  from the grid, cross-validation on a stratified ``foldCol`` (exact folds
  from ``split.stratified_kfold``; feature stages fitted once per fold),
  ROC-AUC, refit of the best.
* ``search_candidates``: the same over several learners and scalers. The feature
  stages are fitted once per fold for all of them, each scaler once per fold, and
  only the learner per parameter map.
* ``search_summary`` / ``select_best``: scores as DataFrames.

Algorithms: logistic regression, random forest, gradient-boosted trees (the
role of the reference's boosted trees; numbers are not meant to be identical).
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.operators.features import FeatureError, assemble, one_hot_stages, tfidf_stages

SCALERS = ("standard", "minmax", "robust", "none")


def estimator(name: str, params: Mapping | None = None, label: str = "label",
              features: str = "features", seed: int = 42):
    from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                           RandomForestClassifier)

    params = dict(params or {})
    if name == "logistic_regression":
        return LogisticRegression(labelCol=label, featuresCol=features, **params)
    if name == "random_forest":
        return RandomForestClassifier(labelCol=label, featuresCol=features, seed=seed, **params)
    if name in ("gbt", "xgboost"):
        return GBTClassifier(labelCol=label, featuresCol=features, seed=seed, **params)
    raise ValueError(f"no learner is called {name!r}")


def scaler_stage(kind: str, inp: str, out: str):
    """The scales of ``features.fit_scaler`` as a pipeline stage; none: no stage."""
    from tabrix.operators.stages import ScaleStage

    if kind not in SCALERS:
        raise FeatureError(f"no scaling is called {kind!r}")
    return None if kind == "none" else ScaleStage(kind=kind, inputCol=inp, outputCol=out)


def feature_stages(numeric: Sequence[str], categorical: Sequence[str], text: str | None,
                   tfidf_max_features: int = 4000, text_terms: str | None = None) -> list:
    """The stages up to ``raw_features``."""
    stages, blocks = [], list(numeric)
    if categorical:
        stages += one_hot_stages(categorical)
        blocks += [f"{c}_ohe" for c in categorical]
    if text:
        stages += tfidf_stages(text, "text_tfidf", tfidf_max_features, terms_col=text_terms)
        blocks.append("text_tfidf")
    return [*stages, assemble(blocks, "raw_features")]


def scaled_stage(scaler: str):
    """The stage from ``raw_features`` to ``features``."""
    from pyspark.ml.feature import SQLTransformer

    sc = scaler_stage(scaler, "raw_features", "features")
    return sc or SQLTransformer(statement="SELECT *, raw_features AS features FROM __THIS__")


def build_pipeline(numeric: Sequence[str], categorical: Sequence[str], text: str | None,
                   algorithm: str, params: Mapping | None = None, scaler: str = "none",
                   label: str = "label", tfidf_max_features: int = 4000, seed: int = 42,
                   text_terms: str | None = None):
    from pyspark.ml import Pipeline

    stages = feature_stages(numeric, categorical, text, tfidf_max_features, text_terms)
    return Pipeline(stages=[*stages, scaled_stage(scaler), estimator(algorithm, params, label, "features", seed)])


def param_grid(pipeline, grid: Mapping[str, Sequence]):
    """ParamMaps over the classifier (last stage) parameters."""
    from pyspark.ml.tuning import ParamGridBuilder

    clf = pipeline.getStages()[-1]
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(clf.getParam(name), list(values))
    return b.build()


def fold_stages(stages: Sequence, train: DataFrame, fold_col: str, num_folds: int) -> list[list]:
    """``stages`` to fit on the rows outside fold 0, 1, ..., and last those for all rows.

    The first stages, as far as they are category and term stages, are fitted
    already: what they count is counted in one pass over ``train`` for all folds.
    """
    from tabrix.operators.stages import CategoryStage, TfidfStage

    out = [list(stages) for _ in range(num_folds + 1)]
    for i, stage in enumerate(stages):
        if not isinstance(stage, (CategoryStage, TfidfStage)):
            break  # it may change the rows that later stages count
        for mine, fitted in zip(out, stage.fold_models(train, fold_col, num_folds), strict=True):
            mine[i] = fitted
    return out


def search(train: DataFrame, pipeline, grid: Mapping[str, Sequence], label: str = "label",
           fold_col: str = "fold", n_iter: int | None = None, seed: int = 42,
           parallelism: int = 2, num_folds: int = 5):
    """Seeded random search (``n_iter`` >= grid size -> the whole grid) with
    cross-validation on ``fold_col``; returns ``(CrossValidatorModel, maps)``.

    The grid holds classifier parameters only (``param_grid``), so inside each
    fold the feature stages (encoders, vocabulary, IDF, scaler) are fitted once
    on the fold's training rows and their vectors persisted; only the
    classifier is fitted per parameter map (``parallelism`` at a time). This is
    ``CrossValidator`` on the whole pipeline without refitting identical
    feature stages for every map; categories and terms of all folds are counted in one pass
    (``fold_stages``). The best map (first wins ties) is refitted as a whole
    pipeline on all of ``train``.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import StorageLevel
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidatorModel

    maps = param_grid(pipeline, grid)
    if n_iter is not None and n_iter < len(maps):
        maps = random.Random(seed).sample(maps, n_iter)
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                       metricName="areaUnderROC", numBins=0)
    stages = pipeline.getStages()
    clf = stages[-1]
    own = fold_stages(stages[:-1], train, fold_col, num_folds)
    keep = [label, clf.getFeaturesCol()]
    scores = [[0.0] * num_folds for _ in maps]
    for k in range(num_folds):
        fit_rows = train.where(F.col(fold_col) != k)
        fmodel = Pipeline(stages=own[k]).fit(fit_rows)
        tr = fmodel.transform(fit_rows).select(*keep).persist(StorageLevel.MEMORY_AND_DISK)
        va = fmodel.transform(train.where(F.col(fold_col) == k)).select(*keep) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        # made once here: fits that start together would each make the rows they do not find yet
        tr.count()
        va.count()

        def run(i, tr=tr, va=va, k=k):
            scores[i][k] = ev.evaluate(clf.fit(tr, maps[i]).transform(va))

        with ThreadPoolExecutor(max(1, min(parallelism, len(maps)))) as pool:
            list(pool.map(run, range(len(maps))))
        tr.unpersist()
        va.unpersist()
    avg = [sum(f) / num_folds for f in scores]
    std = [(sum((x - a) ** 2 for x in f) / num_folds) ** 0.5 for f, a in zip(scores, avg)]
    best = max(range(len(maps)), key=lambda i: (avg[i], -i))
    best_model = Pipeline(stages=[*own[-1], clf]).fit(train, maps[best])
    return CrossValidatorModel(best_model, avg, None, std), maps


@dataclass(frozen=True)
class Candidate:
    """A learner with fixed ``params``, a ``grid`` of further ones, and the scalers to try."""

    algorithm: str
    params: Mapping = field(default_factory=dict)
    grid: Mapping = field(default_factory=dict)
    scalers: tuple[str, ...] = ("none",)

    def draws(self, n_iter: int | None, seed: int) -> list[tuple[str, dict]]:
        """(scaler, params) of the whole grid, or ``n_iter`` of them drawn without replacement."""
        names = sorted(self.grid)
        every = [(s, {**self.params, **dict(zip(names, v, strict=True))})
                 for s in self.scalers for v in itertools.product(*(self.grid[n] for n in names))]
        return every if n_iter is None or n_iter >= len(every) else random.Random(seed).sample(every, n_iter)


@dataclass
class CandidateSearch:
    """``scores``: a row per candidate and fold, and which candidate is selected; ``folds``: a row per fold."""

    model: object
    pipeline: object
    scores: DataFrame
    folds: DataFrame


def search_candidates(train: DataFrame, candidates: Sequence[Candidate], features: Sequence, label: str = "label",
                      key: str | None = None, fold_col: str = "fold", num_folds: int = 5, n_iter: int | None = None,
                      seed: int = 42, parallelism: int = 2) -> CandidateSearch:
    """Cross-validated search over learners, scalers and their parameters.

    ``features`` are the stages up to ``raw_features`` (``feature_stages``). In each
    fold they are fitted once on the fold's training rows, each scaler once on top,
    and the learners ``parallelism`` at a time. Score: mean area under the ROC curve
    over the folds. The first of the best candidates wins, and is refitted as a
    whole pipeline on all of ``train``. ``folds`` counts the rows that were fitted
    and held out, with the sum of the held-out ``key``.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import StorageLevel
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    tries = [(c.algorithm, scaler, params) for c in candidates for scaler, params in c.draws(n_iter, seed)]
    if not tries:
        raise ValueError("nothing to search: no candidate")
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC", numBins=0)
    scores = [[0.0] * num_folds for _ in tries]
    sizes = []
    own = fold_stages(features, train, fold_col, num_folds)
    for k in range(num_folds):
        fit_rows, held_rows = train.where(F.col(fold_col) != k), train.where(F.col(fold_col) == k)
        fitted = Pipeline(stages=own[k]).fit(fit_rows)
        cols = [label, "raw_features"]
        fit_raw = fitted.transform(fit_rows).select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
        held_raw = fitted.transform(held_rows).select(*cols, *([key] if key else [])).persist(StorageLevel.MEMORY_AND_DISK)
        key_sum = F.sum(F.col(key).cast("decimal(38,0)")) if key else F.lit(None).cast("decimal(38,0)")
        held, keys = held_raw.agg(F.count(F.lit(1)), key_sum).first()
        sizes.append((k, fit_raw.count(), held, None if keys is None else int(keys)))
        for scaler in dict.fromkeys(s for _, s, _ in tries):
            stage = scaled_stage(scaler)
            stage = stage.fit(fit_raw) if hasattr(stage, "fit") else stage
            fit_x = stage.transform(fit_raw).select(label, "features").persist(StorageLevel.MEMORY_AND_DISK)
            held_x = stage.transform(held_raw).select(label, "features").persist(StorageLevel.MEMORY_AND_DISK)
            fit_x.count()
            held_x.count()

            def run(i, k=k, fit_x=fit_x, held_x=held_x):
                algorithm, _, params = tries[i]
                scores[i][k] = ev.evaluate(estimator(algorithm, params, label, "features", seed).fit(fit_x).transform(held_x))

            mine = [i for i, t in enumerate(tries) if t[1] == scaler]
            with ThreadPoolExecutor(max(1, min(parallelism, len(mine)))) as pool:
                list(pool.map(run, mine))
            fit_x.unpersist()
            held_x.unpersist()
        fit_raw.unpersist()
        held_raw.unpersist()
    mean = [sum(s) / num_folds for s in scores]
    best = max(range(len(tries)), key=lambda i: (mean[i], -i))
    algorithm, scaler, params = tries[best]
    last = [scaled_stage(scaler), estimator(algorithm, params, label, "features", seed)]
    pipeline = Pipeline(stages=[*features, *last])
    spark = train.sparkSession
    text = lambda p: ", ".join(f"{k}={v}" for k, v in sorted(p.items()))
    table = spark.createDataFrame(
        [(i, a, s, text(p), k, float(scores[i][k]), float(mean[i]), i == best) for i, (a, s, p) in enumerate(tries) for k in range(num_folds)],
        "candidate int, algorithm string, scaler string, params string, fold int, auc double, mean_auc double, selected boolean")
    folds = spark.createDataFrame(sizes, "fold int, n_fit bigint, n_held bigint, held_key_sum bigint")
    return CandidateSearch(Pipeline(stages=[*own[-1], *last]).fit(train), pipeline, table, folds)


def feature_importances(model) -> DataFrame:
    """``(slot, importance)`` of a fitted pipeline whose learner is a tree ensemble (as many rows as features)."""
    from pyspark.sql import SparkSession

    learner = model.stages[-1]
    if not hasattr(learner, "featureImportances"):
        raise ValueError(f"{type(learner).__name__} has no feature importances")
    v = learner.featureImportances
    rows = [(int(i), float(x)) for i, x in zip(v.indices, v.values, strict=True)] if hasattr(v, "indices") else list(enumerate(map(float, v)))
    return SparkSession.getActiveSession().createDataFrame(rows, "slot int, importance double")


def search_summary(spark, cv_model, maps, algorithm: str) -> DataFrame:
    """Rows ``(algorithm, candidate, params, cv_score)``; params stringified."""
    rows = []
    for i, (pm, score) in enumerate(zip(maps, cv_model.avgMetrics)):
        params = ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        rows.append((algorithm, i, params, float(score)))
    return spark.createDataFrame(rows, "algorithm string, candidate int, params string, cv_score double")


def predict(model, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``eval.predict``: class and P(class 1) per row."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("probability"))


def run_info(metrics: DataFrame, model_uri: str, run_id: str, env: str) -> DataFrame:
    """``eval.run_info``: one row (model_uri, run_id, env, metrics map) built
    from the (metric, value) rows (a handful of rows, bounded)."""
    return metrics.agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics")) \
        .select(F.lit(model_uri).alias("model_uri"), F.lit(run_id).alias("run_id"),
                F.lit(env).alias("env"), "metrics")
