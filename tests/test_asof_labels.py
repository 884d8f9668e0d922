"""Champions at evaluation time, label tables, type roles, named labels, and keys with odd names."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tabrix.operators import clean as C
from tabrix.operators import drift as DR
from tabrix.operators import promote as P
from tabrix.operators import quality as Q
from tabrix.operators.contract import QualityRules, TableContract


def test_baseline_is_the_champion_of_the_time(spark):
    rng = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    runs = [("m", "hot" if i % 4 else f"e{i % 12}", i, rng.choice([None, float("nan"), round(rng.random(), 1)]), rng.random() < 0.2,
             t0 + dt.timedelta(hours=rng.randint(0, 60))) for i in range(200)]
    df = spark.createDataFrame(runs, "model_name string, env string, version long, score double, should_retrain boolean, ts timestamp")
    evals = [("m", e, i, t0 + dt.timedelta(hours=rng.randint(-5, 70)), rng.choice([None, rng.random()])) for i in range(150)
             for e in [rng.choice(["hot", "e0", "e4", "none"])]]
    ev = spark.createDataFrame(evals, "model_name string, env string, eval_id int, ts timestamp, value double")
    got = {r["eval_id"]: r for r in DR.model_drift_asof(ev, DR.champion_history(P.ledger(df))).collect()}
    assert len(got) == len(evals)
    for _, env, i, at, value in evals:
        best = None
        for r in sorted((r for r in runs if r[1] == env and r[5] <= at), key=lambda r: (r[5], r[2])):
            if r[3] is not None and r[3] == r[3] and not r[4] and (best is None or r[3] > best[1]):
                best = (r[2], r[3])
        assert (got[i]["baseline_version"], got[i]["baseline_metric"]) == (best or (None, None))
        if best is None:
            assert got[i]["relative_drop"] == 0 and not got[i]["status"]
        elif value is None:
            assert got[i]["relative_drop"] is None and not got[i]["status"]
        else:
            drop = max(0.0, (best[1] - value) / (best[1] if best[1] > 1e-6 else 1.0))
            assert got[i]["relative_drop"] == pytest.approx(drop) and got[i]["status"] == (drop > 0.05)


def test_ledger_ties_nulls_and_nan_against_a_replay(spark):
    rng = random.Random(9)
    runs = [("m", "e", i, rng.choice([None, float("nan"), 0.1, 0.5, 0.5, 0.9]), rng.choice([True, False, None]), i // 3) for i in range(60)]
    df = spark.createDataFrame(runs, "model_name string, env string, version long, score double, should_retrain boolean, ts long")
    for higher in (True, False):
        got = {r["version"]: (r["decision"], r["champion_after"], r["challenger_after"], r["best_score_before"])
               for r in P.ledger(df, higher).collect()}
        best = champion = None
        for _, _, v, s, gated, _ in runs:
            ok = not gated and s is not None and s == s
            before = best
            if ok and (best is None or (s > best if higher else s < best)):
                want = ("promote", v, champion, before)
                best, champion = s, v
            else:
                want = ("skipped_retrain" if gated else "keep", champion, v, before)
            assert got[v] == want


def test_label_tables_of_any_size(spark, monkeypatch):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), F.col("id"))).alias("t"))
    labels = C.fit_label_table(df, "t")
    assert labels.count() == 2001
    out = C.apply_label_table(df, "t", labels, out="i")
    want = {v: i for i, v in enumerate(sorted({r["t"] for r in df.collect()}))}
    assert all(r["i"] == want[r["t"]] for r in out.collect()) and out.count() == 3000
    same = C.apply_label_table(df, "t", labels)
    assert same.columns == ["id", "t"] and same.schema["t"].dataType.simpleString() == "int"
    new = spark.createDataFrame([(1, "hot"), (2, "never")], "id long, t string")
    with pytest.raises(Exception, match="never"):
        C.apply_label_table(new, "t", labels).count()


def test_types_and_named_labels(spark):
    df = spark.createDataFrame([(1, "2", "y"), (2, "x", "B"), (3, "x", "a"), (4, "x", "a"), (5, None, None)], "n long, t string, y string")
    contract = TableContract(columns=("n", "t", "y"), numerical_columns=("t",), categorical_columns=("n", "y"), target_column="y")
    rows = {r["check_name"]: r for r in Q.validate(df, "d", contract, QualityRules(check_types=True)).collect()}
    assert not rows["mistyped_numerical_columns"]["passed"] and "t (string)" in rows["mistyped_numerical_columns"]["message"]
    assert "n (bigint)" in rows["mistyped_categorical_columns"]["message"]
    bad = rows["invalid_target_values"]
    assert bad["observed"] == 2 and bad["message"] == "d: 2 labels of y are not allowed: A, B"
    assert "mistyped_numerical_columns" not in {r["check_name"] for r in Q.validate(df, "d", contract, QualityRules()).collect()}
