import tempfile

import pytest
from pyspark.sql import functions as F

from tabrix.operators import model as M
from tabrix.operators import score as SC
from tabrix.sources import io as IO
from tabrix.streaming import score_stream as ST


def _tmp():
    return tempfile.mkdtemp(prefix="tabrix-test-")


def test_read_table_csv_tokens_and_empty(spark):
    d = _tmp()
    with open(f"{d}/a.csv", "w") as f:
        f.write("x,y,z\n1,NA,?\n2,,b\nnan,N/A,c\n")
    df = IO.read_table(spark, f"{d}/a.csv", fmt="csv")
    got = [tuple(r) for r in df.collect()]
    assert got[0][1] is None and got[0][2] == "?" and got[1][1] is None and got[2][0] is None
    with open(f"{d}/e.csv", "w") as f:
        f.write("x,y\n")
    with pytest.raises(IO.EmptyInputError):
        IO.read_table(spark, f"{d}/e.csv", fmt="csv")


def test_require_inputs_and_reports(spark):
    d = _tmp()
    spark.range(3).write.parquet(f"{d}/ok")
    spark.range(0).write.parquet(f"{d}/empty")
    rep = {r["dataset"]: r for r in IO.require_inputs(spark, {"ok": f"{d}/ok", "empty": f"{d}/empty",
                                                          "gone": f"{d}/gone"}).collect()}
    assert rep["ok"]["passed"] and not rep["empty"]["passed"] and not rep["gone"]["passed"]
    IO.write_report(spark.createDataFrame([("auc", 0.9)], "metric string, value double"), f"{d}/r")
    back = IO.read_report(spark, f"{d}/r", "metric string, value double", required=["metric"])
    assert back.first()["value"] == 0.9
    with pytest.raises(KeyError):
        IO.read_report(spark, f"{d}/r", "metric string, value double", required=["nope"])


def _train(spark):
    rows = [(i, float(i % 7), "a" if i % 3 else "b", f"word{i % 5} claim text", float(i % 2))
            for i in range(60)]
    return spark.createDataFrame(rows, "id long, age double, cat string, combined_text string, label double")


def test_pipeline_batch_and_stream_scoring(spark):
    df = _train(spark)
    pipe = M.build_pipeline(["age"], ["cat"], "combined_text", "logistic_regression",
                            {"maxIter": 5}, scaler="minmax", tfidf_max_features=50)
    model = pipe.fit(df)
    d = _tmp()
    IO.save_model(model, f"{d}/model")
    model = IO.load_model(f"{d}/model")
    expected = ["age", "cat", "combined_text"]
    out = SC.score_batch(model, df, expected, keep=["id"])
    assert out.count() == 60 and set(out.columns) == {"id", "prediction", "probability"}
    with pytest.raises(SC.ScoringInputError, match="combined_text"):
        SC.score_batch(model, df.drop("combined_text"), expected)
    with pytest.raises(SC.ScoringInputError):
        SC.score_batch(model, df.limit(0), expected)
    # streaming: the same rows arrive as files
    df.select("id", *expected).repartition(3).write.parquet(f"{d}/in")
    schema = df.select("id", *expected).schema
    q = ST.start_scoring(spark, model, f"{d}/in", schema, expected, ["id"], f"{d}/out", f"{d}/ckpt")
    q.awaitTermination(120)
    streamed = spark.read.parquet(f"{d}/out")
    assert streamed.count() == 60
    j = streamed.join(out, "id").where(F.abs(streamed.probability - out.probability) > 1e-12)
    assert j.count() == 0


def test_search_and_summary(spark):
    from tabrix.operators import split as S

    df = S.stratified_kfold(_train(spark), "id", "label", 3, out="fold")
    pipe = M.build_pipeline(["age"], ["cat"], None, "logistic_regression", {"maxIter": 5})
    cv, maps = M.search(df, pipe, {"regParam": [0.0, 0.1, 1.0]}, n_iter=2, num_folds=3, parallelism=1)
    s = M.search_summary(spark, cv, maps, "lr")
    assert s.count() == 2 and all(0 <= r["cv_score"] <= 1 for r in s.collect())
    metrics = spark.createDataFrame([("auc", 0.8), ("f1", 0.5)], "metric string, value double")
    info = M.run_info(metrics, "models:/m/1", "run1", "dev").first()
    assert info["metrics"]["auc"] == 0.8 and info["env"] == "dev"


def test_search_matches_crossvalidator_on_whole_pipeline(spark):
    """Feature stages fitted once per fold give the scores of CrossValidator
    refitting the whole pipeline for every parameter map."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    from tabrix.operators import split as S

    df = S.stratified_kfold(_train(spark), "id", "label", 3, out="fold").cache()
    pipe = M.build_pipeline(["age"], ["cat"], None, "logistic_regression", {"maxIter": 5},
                            scaler="standard")
    cv, maps = M.search(df, pipe, {"regParam": [0.0, 0.1]}, num_folds=3, parallelism=2)
    ev = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", numBins=0)
    ref = CrossValidator(estimator=pipe, estimatorParamMaps=maps, evaluator=ev, foldCol="fold",
                         numFolds=3).fit(df)
    assert [round(float(x), 9) for x in cv.avgMetrics] == \
        [round(float(x), 9) for x in ref.avgMetrics]
    df.unpersist()


def test_oversample_repeat(spark):
    from tabrix.operators.resample import oversample_repeat

    df = spark.createDataFrame([(i, 1 if i < 3 else 0) for i in range(10)], "id long, y int")
    out = oversample_repeat(df, "y", "id")
    c = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert c == {0: 7, 1: 7}
    assert out.where("copy_id = 0").count() == 10
