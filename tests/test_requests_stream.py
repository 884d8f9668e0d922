"""Scoring of a stream of JSON requests: bad and repeated ones, restarts, and equality with the batch."""

import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from tabrix.operators import model as M
from tabrix.operators import score as SC
from tabrix.streaming import score_stream as ST

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampType()), T.StructField("age", T.DoubleType()),
                       T.StructField("cat", T.StringType())])
EXPECTED = ["age", "cat"]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, float(i % 7), "a" if i % 3 else "b", float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, age double, cat string, label double")
    return M.build_pipeline(["age"], ["cat"], None, "logistic_regression", {"maxIter": 5}).fit(df)


def request(i, minute=0, **kw):
    at = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
    return json.dumps({"id": i, "at": at.isoformat(), "age": float(i % 5), "cat": "ab"[i % 2], **kw})


def test_reasons(spark):
    lines = [request(1), "{broken", "[1, 2]", "7", "", json.dumps({"id": 1, "age": 2.0}), request(2, age=None), request(3, age="old"),
             json.dumps({"id": None, "at": "2024-01-01T00:00:00", "age": 1.0, "cat": "a"}), None]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [r["reason"] for r in SC.checked_requests(raw, SCHEMA, ["age", "cat"], ["id"]).collect()]
    bad = "not a JSON object of the expected types"
    assert got == [None, bad, bad, bad, bad, "lacks cat", None, bad, "no value for id", bad]


def test_stream_equals_batch_over_restarts(spark, model, tmp_path):
    src, sink, bad, ckpt = (str(tmp_path / x) for x in ("in", "out", "bad", "ckpt"))
    (tmp_path / "in").mkdir()

    def arrive(name, lines):
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")

    def run():
        q = ST.start_request_scoring(spark, model, src, SCHEMA, EXPECTED, "id", "at", sink, bad, ckpt, max_files_per_trigger=1)
        q.awaitTermination(120)
        assert q.exception() is None

    first = [request(i, i) for i in range(20)]
    arrive("a.txt", [*first, "{broken", json.dumps({"id": 99, "at": "2024-01-01T00:00:00", "age": 1.0})])
    arrive("b.txt", [first[3], request(30, 21), first[3]])
    run()
    arrive("c.txt", [*first[:10], request(31, 22), '{"id": "x"}'])  # a restart, with a file that repeats old requests
    run()
    run()  # nothing new
    out = spark.read.parquet(sink)
    assert sorted(r["id"] for r in out.collect()) == [*range(20), 30, 31]
    rows = [json.loads(request(i)) for i in [*range(20), 30, 31]]
    df = spark.createDataFrame([(r["id"], r["age"], r["cat"]) for r in rows], "id bigint, age double, cat string")
    want = {r["id"]: (r["prediction"], r["probability"]) for r in SC.score_batch(model, df, EXPECTED, ["id"]).collect()}
    assert {r["id"]: (r["prediction"], r["probability"]) for r in out.collect()} == want
    reasons = sorted(r["reason"] for r in spark.read.parquet(bad).collect())
    assert reasons == ["lacks cat", *["not a JSON object of the expected types"] * 2]


def test_a_batch_that_runs_again_replaces_its_output(spark, model, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(request(i, i) for i in range(5)))
    for _ in range(2):  # the second time without the commit record of the first
        ckpt = tmp_path / "ckpt"
        commits = list((ckpt / "commits").glob("*")) if ckpt.exists() else []
        for f in commits:
            f.unlink()
        q = ST.start_request_scoring(spark, model, str(tmp_path / "in"), SCHEMA, EXPECTED, "id", "at", str(tmp_path / "out"),
                                     str(tmp_path / "bad"), str(ckpt))
        q.awaitTermination(120)
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2, 3, 4]


def test_missing_columns_are_one_error(spark, model):
    df = spark.createDataFrame([(1, 2.0)], "id bigint, age double")
    with pytest.raises(SC.ScoringInputError, match="cat"):
        ST.scored_stream(df, model, EXPECTED, ["id"])
