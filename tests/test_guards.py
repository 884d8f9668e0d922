"""Errors that every action raises, missing scores, many classes, and the cleaning of keyed frames."""

import pytest
from pyspark.sql import functions as F

from tabrix.operators import clean as C
from tabrix.operators import drift as D
from tabrix.operators import promote as P
from tabrix.operators import resample as R
from tabrix.plans.flow import FlowConfig, clean_frame
from tabrix.session import checkpoint_dir
from tabrix.sources import io as IO

ACTIONS = [lambda df: df.collect(), lambda df: df.count()]


@pytest.mark.parametrize("act", ACTIONS)
def test_missing_values_are_errors_for_every_action(spark, act, tmp_path):
    metrics = "metric string, value double"
    base = spark.createDataFrame([("auc", 0.8)], metrics)
    for current in ([], [("f1", 0.5)], [("auc", None)]):
        with pytest.raises(Exception, match="holds no auc"):
            act(D.model_drift(spark.createDataFrame(current, metrics), base))
    assert act(D.model_drift(base, base)) in (1, [("auc", 0.8, 0.8, 0.0, 0.05, False)])
    runs = spark.createDataFrame([("1", None), (None, None)], "version string, candidate_version string")
    with pytest.raises(Exception, match="names no version"):
        act(P.version_key(runs))
    spark.createDataFrame([("a", 1), (None, 2)], "name string, n int").write.json(f"{tmp_path}/report")
    with pytest.raises(Exception, match="has no name"):
        act(IO.read_report(spark, f"{tmp_path}/report", "name string, n int", ["name"]))


def test_missing_scores_are_never_best(spark):
    nan = float("nan")
    scores = spark.createDataFrame([("g", "c1", None), ("g", "c2", 0.9), ("g", "c0", nan), ("h", "x", nan)], "g string, c string, s double")
    assert [tuple(r) for r in P.select_best(scores, "g", "c", "s").collect()] == [("g", "c2", 0.9)]
    runs = [(1, "1", None), (2, "2", nan), (3, "3", 0.7), (4, "4", nan), (5, "5", 0.8), (6, "6", None)]
    df = spark.createDataFrame([("m", "e", t, v, s, False) for t, v, s in runs],
                               "model_name string, env string, ts int, version string, score double, should_retrain boolean")
    got = {r.ts: (r.decision, r.champion_after) for r in P.ledger(df).collect()}
    assert got == {1: ("keep", None), 2: ("keep", None), 3: ("promote", "3"), 4: ("keep", "3"), 5: ("promote", "5"), 6: ("keep", "5")}


def test_oversampling_levels_every_class(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 50, F.lit(-1)).otherwise(F.col("id")).alias("c"))
    out = R.oversample_repeat(df, "c", "id").groupBy("c").count().groupBy("count").count().collect()
    assert [tuple(r) for r in out] == [(50, 2951)]
    one = R.oversample_repeat(df.where("c = -1"), "c", "id")
    assert one.count() == 50 and one.where("copy_id != 0").count() == 0


def test_keys_do_not_hide_equal_or_empty_rows(spark):
    rows = [("00", " a ", "1", "y"), ("01", "a", "1", "y"), ("02", None, "?", None), ("03", "b", "2", "y"), ("04", "b", "3", None)]
    df = spark.createDataFrame(rows, "row_id string, name string, amount string, target string")
    cfg = FlowConfig(key="row_id", text_columns=(), date_columns=(), date_diff=None, renames={}, value_maps={})
    out, coerced, _ = clean_frame(df, cfg, "target")
    assert sorted((r.row_id, r.name, r.amount) for r in out.collect()) == [("00", "a", 1.0), ("03", "b", 2.0)]
    assert coerced == ["amount"]


def test_joins_keep_their_null_filters(spark):
    a = spark.createDataFrame([(1, 2)], "k int, a int")
    b = spark.createDataFrame([(1, 3)], "k int, b int")
    assert "isnotnull" in a.join(b, "k")._jdf.queryExecution().optimizedPlan().toString()


def test_booleans_take_the_mode(spark):
    df = spark.createDataFrame([(True, 1), (True, 2), (False, 3), (None, 4)], "b boolean, k int")
    out = C.impute(df, exclude=["k"])
    assert out.schema["b"].dataType.simpleString() == "boolean"
    assert [r.b for r in out.orderBy("k").collect()] == [True, True, False, True]


def test_csv_types_after_missing_values(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c,d,e\n1,1.5,true,x,NA\nNA,NA,?,NA,NA\n3,2,false,y,NA\n")
    df = IO.read_table(spark, str(tmp_path / "t.csv"), "csv", na_tokens=["NA", "?"])
    assert dict(df.dtypes) == {"a": "bigint", "b": "double", "c": "boolean", "d": "string", "e": "string"}
    assert [tuple(r) for r in df.collect()] == [(1, 1.5, True, "x", None), (None,) * 5, (3, 2.0, False, "y", None)]


def test_clusters_must_name_a_shared_folder(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="share"):
        checkpoint_dir(Session())
