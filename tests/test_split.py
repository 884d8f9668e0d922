import pytest
from pyspark.sql import functions as F

from tabrix.operators import split as S


def _frame(spark, n=1000):
    return spark.range(n).select(F.col("id"), F.when(F.col("id") % 10 < 3, "pos")
                                 .otherwise("neg").alias("cls"))


def test_stratified_split_exact(spark):
    out = S.stratified_split(_frame(spark), "id", "cls", 0.2, 42)
    counts = {(r["cls"], r["is_test"]): r["count"] for r in out.groupBy("cls", "is_test").count().collect()}
    assert counts[("pos", True)] == 60 and counts[("neg", True)] == 140
    assert out.count() == 1000 and out.select("id").distinct().count() == 1000
    again = S.stratified_split(_frame(spark), "id", "cls", 0.2, 42)
    assert out.subtract(again).count() == 0


def test_largest_remainder():
    alloc = S.allocate({"a": 5, "b": 5, "c": 1}, 0.25)
    # remainders all 0.25: the leftover row goes to the smallest class name
    assert sum(alloc.values()) == 3 and alloc == {"a": 2, "b": 1, "c": 0}


def test_split_bounds(spark):
    with pytest.raises(ValueError):
        S.random_split(_frame(spark), "id", 1.0)


def test_split_frames_disjoint(spark):
    train, test = S.split_frames(_frame(spark), "id", "cls", 0.25)
    assert train.count() + test.count() == 1000
    assert train.join(test, "id").count() == 0


def test_kfold_balanced(spark):
    out = S.stratified_kfold(_frame(spark), "id", "cls", 5)
    c = {(r["cls"], r["fold"]): r["count"] for r in out.groupBy("cls", "fold").count().collect()}
    assert all(v == 60 for k, v in c.items() if k[0] == "pos")
    assert all(v == 140 for k, v in c.items() if k[0] == "neg")


def test_sample_n(spark):
    s = S.sample_n(_frame(spark), 50, "id")
    assert s.count() == 50 and s.select("id").distinct().count() == 50
    assert S.sample_n(_frame(spark, 10), 50, "id").count() == 10


def test_many_classes_equal_the_small_allocation(spark):
    # as many classes as rows in some, NULL among them
    df = spark.range(4000).select("id", F.when(F.col("id") % 7 > 0, (F.col("id") * F.col("id")) % 1009).alias("cls"))
    sizes = {r["cls"]: r["count"] for r in df.groupBy("cls").count().collect()}
    assert len(sizes) > 400
    out = S.stratified_split(df, "id", "cls", 0.3, 7)
    got = {r["cls"]: r["n"] for r in out.groupBy("cls").agg(F.count_if("is_test").alias("n")).collect()}
    assert got == S.allocate(sizes, 0.3)


def test_boundary_equals_ranking(spark, monkeypatch):
    import hashlib

    monkeypatch.setattr(S, "SMALL", 3)  # several rounds
    monkeypatch.setattr(S, "BITS", 4)
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") < 2900, "hot").otherwise("cold").alias("cls"))
    test = {r["id"] for r in S.stratified_split(df, "id", "cls", 0.25, 1).where("is_test").collect()}
    want = set()
    for ids, k in ((range(2900), 725), (range(2900, 3000), 25)):
        want |= set(sorted(ids, key=lambda i: (hashlib.md5(f"1:{i}".encode()).hexdigest(), i))[:k])
    assert test == want
    assert {r["id"] for r in S.random_split(df, "id", 0.25, 1).where("is_test").collect()} == set(
        sorted(range(3000), key=lambda i: (hashlib.md5(f"1:{i}".encode()).hexdigest(), i))[:750])


def test_split_of_an_empty_table_and_plan(spark):
    df = _frame(spark)
    assert S.stratified_split(df.limit(0), "id", "cls", 0.25).count() == 0
    plan = S.stratified_split(df, "id", "cls", 0.25)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
