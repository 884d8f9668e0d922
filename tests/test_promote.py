import datetime as dt

from tabrix.operators import promote as P


def test_promotion_micro_fixture(spark):
    t0 = dt.datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [("m", "dev", v, s, g, t0 + dt.timedelta(days=v)) for v, s, g in
         [(1, 0.80, False), (2, 0.79, False), (3, 0.80, False), (4, 0.90, True), (5, 0.85, False)]],
        "model_name string, env string, version long, score double, should_retrain boolean, ts timestamp")
    got = {r["version"]: (r["decision"], r["champion_after"], r["challenger_after"])
           for r in P.ledger(runs).collect()}
    assert got == {1: ("promote", 1, None), 2: ("keep", 1, 2), 3: ("keep", 1, 3),
                   4: ("skipped_retrain", 1, 4), 5: ("promote", 5, 1)}
    cur = P.current_aliases(P.ledger(runs)).first()
    assert cur["champion"] == 5 and cur["challenger"] == 1 and cur["champion_score"] == 0.85


def test_lower_is_better(spark):
    runs = spark.createDataFrame([("m", "e", 1, 0.5, False, 1), ("m", "e", 2, 0.4, False, 2),
                                  ("m", "e", 3, 0.45, False, 3)],
                                 "model_name string, env string, version long, score double, "
                                 "should_retrain boolean, ts long")
    d = {r["version"]: r["decision"] for r in P.ledger(runs, higher_is_better=False).collect()}
    assert d == {1: "promote", 2: "promote", 3: "keep"}


def test_select_best_ties_first(spark):
    s = spark.createDataFrame([("xgb", 2, 0.9), ("xgb", 1, 0.9), ("lr", 3, 0.7)],
                              "algo string, cand long, score double")
    got = {r["algo"]: r["best_candidate"] for r in P.select_best(s, "algo", "cand", "score").collect()}
    assert got == {"xgb": 1, "lr": 3}


def test_version_key(spark):
    df = spark.createDataFrame([(None, "7")], "version string, candidate_version string")
    assert P.version_key(df).first()["version"] == "7"
