"""Exact quantiles by bracket against sorting; joins with hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from tabrix.operators import stats as ST
from tabrix.operators.keyed import hot_keys, join_unique


def exact(values, p):
    v = sorted(values)
    h = (len(v) - 1) * p
    lo, hi = int(h // 1), -int(-h // 1)
    return v[lo] if lo == hi else (hi - h) * v[lo] + (h - lo) * v[hi]


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("grid", [256, 4])
def test_quantiles_equal_sorting(spark, monkeypatch, grid):
    monkeypatch.setattr(ST, "GRID", grid)
    rng = random.Random(1)
    rows = [(rng.gauss(0, 1), float(rng.choice([0, 0, 0, 1, 7])), float(i % 2), None, float("nan") if i % 3 else 5.0, rng.randint(0, 9))
            for i in range(5000)]
    df = spark.createDataFrame(rows, "a double, ties double, b double, void double, c double, n int")
    got = {(r["column"], r["prob"]): r["value"] for r in ST.exact_quantiles(df, ["a", "ties", "b", "void", "c", "n"], PROBS).collect()}
    for i, c in enumerate(["a", "ties", "b", "void", "c", "n"]):
        values = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
        for p in PROBS:
            assert got.get((c, p)) == (exact(values, p) if values else None), (c, p)


def test_a_missed_bracket_is_opened(spark):
    long = spark.range(1000).select(F.lit("x").alias("column"), F.col("id").cast("double").alias("value"))
    wrong = spark.createDataFrame([("x", 1000, [900.0] * (ST.GRID + 1))], "column string, n bigint, grid array<double>")
    targets = spark.createDataFrame([("x", 17), ("x", 999)], "column string, j bigint")
    got = {r["j"]: r["value"] for r in ST.order_statistics(long, targets, wrong).collect()}
    assert got == {17: 17.0, 999: 999.0}


def test_small_and_empty_columns(spark):
    df = spark.createDataFrame([(1.5,)], "a double")
    assert [r["value"] for r in ST.exact_quantiles(df, ["a"], [0.25, 0.5]).collect()] == [1.5, 1.5]
    assert ST.exact_quantiles(df.limit(0), ["a"], [0.5]).count() == 0
    assert ST.exact_quantiles(df, [], [0.5]).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_unique_equals_a_join(spark, how):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 5 == 0 else f"k{i % 50}", i) for i in range(3000)] + [(-1, "alone", 0)] * 20
    left = spark.createDataFrame(rows, "id bigint, k string, `a.b` int")
    right = spark.createDataFrame([("hot", 1.5), *((f"k{i}", float(i)) for i in range(0, 60, 2))], "k string, v double")
    got = join_unique(left, right, ["k"], how)
    want = left.join(right, ["k"], how)
    assert sorted(map(repr, (tuple(r) for r in got.select("id", "k", "`a.b`", "v").collect()))) == \
        sorted(map(repr, (tuple(r) for r in want.select("id", "k", "`a.b`", "v").collect())))
    hot = {r["k"] for r in hot_keys(left, ["k"], share=10).collect()}
    assert hot == {"hot"}
