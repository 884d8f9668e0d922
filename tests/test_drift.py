from tabrix.operators import drift as DR


def test_reference_data_drift_case(spark):
    ref = spark.createDataFrame([(30, 0), (31, 0), (29, 1), (30, 0)], "age long, target long")
    cur = spark.createDataFrame([(80, 0), (82, 1), (79, 1), (81, 1)], "age long, target long")
    f = DR.feature_drift(ref, cur, "target", 0.1, 0.2)
    row = f.first()
    assert abs(row["score"] - (80.5 - 30) / 30) < 1e-12 and row["drifted"]
    s = DR.data_drift(f, 0.1).first()
    assert s["drifted_feature_ratio"] == 1.0 and s["status"]


def test_reference_concept_case(spark):
    ref = spark.createDataFrame([(0,), (0,), (0,), (1,)], "target long")
    cur = spark.createDataFrame([(1,), (1,), (1,), (1,)], "target long")
    c = DR.concept_drift(ref, cur, "target", 0.2).first()
    assert c["reference_target_rate"] == 0.25 and c["current_target_rate"] == 1.0
    assert c["delta"] == 0.75 and c["status"]
    missing = DR.concept_drift(ref.withColumnRenamed("target", "t"), cur, "target").first()
    assert missing["status"] is False and "no column target" in missing["message"]


def test_reference_model_case(spark):
    cur = spark.createDataFrame([("auc", 0.70)], "metric string, value double")
    base = spark.createDataFrame([("auc", 0.85)], "metric string, value double")
    m = DR.model_drift(cur, base, "auc", 0.1).first()
    assert abs(m["relative_drop"] - 0.15 / 0.85) < 1e-12 and m["status"]
    doc = DR.model_drift(spark.createDataFrame([("auc", 0.84)], "metric string, value double"),
                         spark.createDataFrame([("auc", 0.90)], "metric string, value double"),
                         "auc", 0.05).first()
    assert abs(doc["relative_drop"] - 0.0666666) < 1e-6 and doc["status"]
    none = DR.model_drift(cur, base.limit(0), "auc", 0.1).first()
    assert none["relative_drop"] == 0.0 and none["status"] is False


def test_psi_identity_and_segments(spark):
    df = spark.createDataFrame([("a", "d1"), ("b", "d1"), ("a", "d2"), ("c", "d2"), (None, "d2")],
                               "x string, day string")
    assert abs(DR.psi(df, df, ["x"]).first()["score"]) < 1e-12
    seg = {r["day"]: r["score"] for r in DR.psi(df, df, ["x"], by=["day"]).collect()}
    for day in ("d1", "d2"):
        direct = DR.psi(df, df.where(f"day = '{day}'"), ["x"]).first()["score"]
        assert abs(seg[day] - direct) < 1e-9


def test_retrain_signal(spark):
    d = spark.createDataFrame([(False,)], "status boolean")
    t = spark.createDataFrame([(True,)], "status boolean")
    r = DR.retrain_signal(d, d, t).first()
    assert r["should_retrain"] and r["model_drift"] and not r["data_drift"]
