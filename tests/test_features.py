import math
from collections import Counter

from pyspark.sql import functions as F

from tabrix.operators import features as FE


def test_tfidf_against_brute_force(spark):
    docs = [(1, "The cat sat. The cat ran!"), (2, "A dog sat; the dog ran"), (3, "Émile vit le chat"),
            (4, "cat cat dog"), (5, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    vocab = FE.fit_tfidf(df, "doc_id", "text", max_features=5, min_df=2, max_df=0.95)
    got_v = {r["term"]: r["idf"] for r in vocab.collect()}
    # brute force
    import re
    toks = {d: re.findall(r"(?u)\b\w\w+\b", (t or "").lower()) for d, t in docs}
    grams = {d: t + [f"{a} {b}" for a, b in zip(t, t[1:])] for d, t in toks.items()}
    dfc = Counter(g for d in grams for g in set(grams[d]))
    cf = Counter(g for d in grams for g in grams[d])
    n = len(docs)
    keep = [g for g in dfc if 2 <= dfc[g] <= 0.95 * n]
    top = sorted(keep, key=lambda g: (-cf[g], g))[:5]
    assert set(got_v) == set(top)
    for g in top:
        assert abs(got_v[g] - (math.log((1 + n) / (1 + dfc[g])) + 1)) < 1e-12
    w = FE.tfidf_long(df, "doc_id", "text", vocab)
    norms = w.groupBy("doc_id").agg(F.sum(F.col("tfidf") ** 2).alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in norms)


def test_one_hot_long_unseen(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "k long, c string")
    vocab = FE.fit_one_hot(train, ["c"])
    assert {r["category"]: r["category_index"] for r in vocab.collect()} == {"a": 0, "b": 1}
    test = spark.createDataFrame([(9, "z"), (8, "b")], "k long, c string")
    got = {r["k"]: r["category_index"] for r in FE.one_hot_long(test, "k", ["c"], vocab).collect()}
    assert got == {9: None, 8: 1}


def test_scalers_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (5.0, 5.0)], "x double, c double")
    std = FE.scale(df, ["x", "c"], "standard").collect()
    assert abs(std[0]["x"] - 1 / math.sqrt(8 / 3)) < 1e-12 and std[0]["c"] == 5.0
    mm = FE.scale(df, ["x", "c"], "minmax").collect()
    assert [r["x"] for r in mm] == [0.0, 0.5, 1.0] and all(r["c"] == 0.0 for r in mm)
    rb = FE.scale(df, ["x", "c"], "robust").collect()
    assert [r["x"] for r in rb] == [-1.0, 0.0, 1.0] and all(r["c"] == 0.0 for r in rb)


def test_frame_and_manifest(spark):
    df = spark.createDataFrame([("y", 1, "a", "b", 2.0)], "t string, n long, occ string, hob string, z double")
    f = FE.feature_frame(df, "t", ["occ", "hob"])
    assert f.columns == ["n", "z", "combined_text", "t"]
    m = FE.manifest(f, "t")
    assert m["numeric_columns"] == ["n", "z"] and m["categorical_columns"] == []


def test_pipeline_scalers_equal_the_relational_ones(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.functions import vector_to_array

    from tabrix.operators.model import scaler_stage

    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (5.0, 5.0)], "a double, b double")
    for kind in ("standard", "minmax"):
        want = sorted(tuple(r) for r in FE.scale(df, ["a", "b"], kind).collect())
        model = Pipeline(stages=[FE.assemble(["a", "b"], "v"), scaler_stage(kind, "v", "f")]).fit(df)
        model.write().overwrite().save(f"{tmp_path}/{kind}")
        for m in (model, PipelineModel.load(f"{tmp_path}/{kind}")):
            got = sorted(tuple(r.f) for r in m.transform(df).select(vector_to_array("f").alias("f")).collect())
            assert [[round(x, 9) for x in r] for r in got] == [[round(x, 9) for x in r] for r in want]
