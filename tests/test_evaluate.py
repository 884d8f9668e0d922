from pyspark.sql import functions as F

from tabrix.operators import evaluate as EV


def _fixture(spark):
    return spark.createDataFrame([(0, 0.1, 0), (0, 0.4, 0), (1, 0.35, 0), (1, 0.8, 1)],
                                 "label int, score double, prediction int")


def test_metrics_micro_fixture(spark):
    m = {r["metric"]: r["value"] for r in EV.binary_metrics(_fixture(spark)).collect()}
    assert abs(m["auc"] - 0.75) < 1e-12
    assert abs(m["pr_auc"] - 0.8333333333333333) < 1e-12
    assert m["accuracy"] == 0.75 and m["precision"] == 1.0 and m["recall"] == 0.5
    assert abs(m["f1"] - 2 / 3) < 1e-12 and m["balanced_accuracy"] == 0.75
    import math
    ll = -(math.log(0.9) + math.log(0.6) + math.log(0.35) + math.log(0.8)) / 4
    assert abs(m["log_loss"] - ll) < 1e-12


def test_confusion_cells(spark):
    c = {(r["actual"], r["predicted"]): r["n"] for r in EV.confusion(_fixture(spark)).collect()}
    assert c == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 1}


def test_auc_ties_and_reversal(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.5), (1, 0.9), (0, 0.1), (1, 0.1)], "label int, score double")
    auc = EV.roc_auc(df).first()[0]
    # pairs (pos, neg): 6 pairs; wins: 0.5>0.1, 0.9>0.5, 0.9>0.1 = 3, ties: (0.5,0.5), (0.1,0.1) = 2
    assert abs(auc - (3 + 0.5 * 2) / 6) < 1e-12
    rev = EV.roc_auc(df.withColumn("score", -F.col("score"))).first()[0]
    assert abs(rev - (1 - auc)) < 1e-12


def test_classification_report(spark):
    r = {x["row_name"]: x for x in EV.classification_report(_fixture(spark)).collect()}
    assert r["1"]["support"] == 2 and r["0"]["precision"] == 2 / 3
    assert r["accuracy"]["f1_score"] == 0.75
    assert abs(r["macro avg"]["recall"] - 0.75) < 1e-12


def test_single_class_segment_gives_null_auc_and_ap(spark):
    df = spark.createDataFrame([("a", 0, 0.2), ("a", 0, 0.7), ("b", 1, 0.3), ("b", 0, 0.6)],
                               "seg string, label int, score double")
    auc = {r["seg"]: r["auc"] for r in EV.roc_auc(df, by=["seg"]).collect()}
    ap = {r["seg"]: r["pr_auc"] for r in EV.average_precision(df, by=["seg"]).collect()}
    assert auc == {"a": None, "b": 0.0}
    assert ap["a"] is None and abs(ap["b"] - 0.5) < 1e-12
