import json
import tempfile

import pytest
from pyspark.sql import functions as F

from tabrix.functions import text as X
from tabrix.operators import clean as C
from tabrix.operators import features as FE


def test_lemmatize_join_keeps_order(spark):
    df = spark.createDataFrame([(1, ["cars", "ran", "cars"]), (2, []), (3, None)],
                               "k long, toks array<string>")
    lem = spark.createDataFrame([("cars", "car"), ("ran", "run")], "token string, lemma string")
    out = {r["k"]: r["toks"] for r in X.lemmatize_join(df, "k", "toks", lem).collect()}
    assert out[1] == ["car", "run", "car"]
    assert not out[2] and not out[3]


def test_drop_null_target(spark):
    df = spark.createDataFrame([(1, "Y"), (2, None)], "k long, t string")
    assert [r["k"] for r in C.drop_null_target(df, "t").collect()] == [1]


def test_assemble_requires_blocks():
    with pytest.raises(FE.FeatureError):
        FE.assemble([])


def test_json_request_stream(spark):
    from tabrix.streaming.score_stream import read_stream

    d = tempfile.mkdtemp(prefix="tabrix-req-")
    with open(f"{d}/req.json", "w") as f:
        for i in range(5):
            f.write(json.dumps({"age": 40 + i, "combined_text": "test incident text"}) + "\n")
    stream = read_stream(spark, d, "age long, combined_text string", fmt="json-requests")
    q = stream.writeStream.format("memory").queryName("reqs").trigger(availableNow=True).start()
    q.awaitTermination(60)
    rows = spark.sql("SELECT * FROM reqs").collect()
    assert len(rows) == 5 and rows[0]["combined_text"] == "test incident text"


def test_sample_by_approximate(spark):
    from tabrix.operators.split import sample_by

    df = spark.range(2000).select("id", (F.col("id") % 2).alias("c"))
    n = sample_by(df, "c", {0: 0.5, 1: 0.1}).count()
    assert 400 < n < 800
