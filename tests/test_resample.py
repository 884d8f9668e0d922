"""Neighbour oversampling against plain Python: exact neighbours where the window holds the class, whole counts."""

import hashlib
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tabrix.operators import resample as R

SCHEMA = "id bigint, y string, a string, b int, other double"


def frame_rows(n=160, seed=3):
    rng = random.Random(seed)
    return [(i, "rare" if i % 6 == 0 else "odd" if i % 9 == 0 else "common", rng.choice(["x", "y", "z", "", None]),
             rng.choice([1, 2, 3, 40, None]), float(i)) for i in range(n)]


def name(v):
    return "" if v is None else "=" + str(v)


def exact(rows, k, seed=42):
    """key -> (a, b) made of the k nearest rows of the same class."""
    classes = sorted({name(r[1]) for r in rows})
    shares = defaultdict(lambda: [0] * len(classes))
    for f in (2, 3):
        for v in {name(r[f]) for r in rows}:
            of = [name(r[1]) for r in rows if name(r[f]) == v]
            shares[f, v] = [of.count(c) * 1_000_000 // len(of) for c in classes]
    h = {r[0]: hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest() for r in rows}
    out = {}
    for r in rows:
        others = [o for o in rows if o[1] == r[1] and o[0] != r[0]]
        dist = lambda o: sum(sum(abs(s - t) for s, t in zip(shares[f, name(r[f])], shares[f, name(o[f])], strict=True)) ** 2 for f in (2, 3))  # noqa: B023, E731
        near = sorted(others, key=lambda o: (dist(o), h[o[0]], o[0]))[:k]
        mode = lambda f: min(Counter(name(o[f]) for o in near).items(), key=lambda x: (-x[1], x[0]))[0]  # noqa: B023, E731
        a, b = mode(2), mode(3)
        out[r[0]] = (a[1:] if a else None, int(b[1:]) if b else None)
    return out


def test_neighbours_equal_exact_search_where_the_window_holds_the_class(spark):
    rows = frame_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    out = R.oversample_neighbours(df, "y", "id", ["a", "b"], k=5, window=200)
    assert out.columns == [*df.columns, "copy_id"]
    made = out.where("copy_id > 0").collect()
    want = exact(rows, 5)
    source = {r[0]: r for r in rows}
    assert made and all((r["a"], r["b"]) == want[r["id"]] and r["y"] == source[r["id"]][1] and r["other"] == source[r["id"]][4] for r in made)
    repeat = R.oversample_repeat(df, "y", "id")
    assert Counter((r["id"], r["copy_id"]) for r in made) == Counter((r["id"], r["copy_id"]) for r in repeat.where("copy_id > 0").collect())
    sizes = {r["count"] for r in out.groupBy("y").count().collect()}
    assert len(sizes) == 1
    assert out.where("copy_id = 0").drop("copy_id").exceptAll(df).count() == 0 and out.where("copy_id = 0").count() == len(rows)


def test_a_small_window_finds_neighbours_as_near(spark):
    rng = random.Random(8)
    rows = [(i, "rare" if i % 4 == 0 else "common", f"v{rng.randint(0, 30)}", rng.randint(0, 8), 0.0) for i in range(1200)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = R.oversample_neighbours(df, "y", "id", ["a", "b"]).where("copy_id = 1").collect()
    want = exact(rows, 5)
    same = sum((r["a"], r["b"]) == want[r["id"]] for r in out) / len(out)
    assert same > 0.5  # the rest are made of other near rows


def test_edges_of_blocks_and_hot_rows(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 7)
    rows = frame_rows(90)
    df = spark.createDataFrame(rows, SCHEMA)
    a = R.oversample_neighbours(df, "y", "id", ["a", "b"], window=5)
    monkeypatch.setattr(R, "BLOCK", 8192)
    b = R.oversample_neighbours(df, "y", "id", ["a", "b"], window=5)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    same = spark.range(400).select("id", F.when(F.col("id") < 100, "r").otherwise("c").alias("y"), F.lit("q").alias("a"),
                                   F.lit(1).alias("b"), F.lit(0.0).alias("other"))
    out = R.oversample_neighbours(same, "y", "id", ["a", "b"])
    assert out.count() == 600 and out.select("a", "b").distinct().count() == 1


def test_alone_in_a_class_one_class_and_empty(spark):
    rows = [(1, "r", "x", 1, 0.0), (2, "c", "y", 2, 0.0), (3, "c", "z", 3, 0.0), (4, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = R.oversample_neighbours(df, "y", "id", ["a", "b"])
    assert sorted((r["id"], r["a"], r["copy_id"]) for r in out.where("id IN (1, 4)").collect()) == [(1, "x", 0), (1, "x", 1), (4, None, 0), (4, None, 1)]
    one = df.where("y = 'c'")
    assert R.oversample_neighbours(one, "y", "id", ["a", "b"]).count() == 2
    assert R.oversample_neighbours(df.limit(0), "y", "id", ["a", "b"]).count() == 0


def test_no_join_of_all_pairs(spark):
    df = spark.createDataFrame(frame_rows(), SCHEMA)
    plan = R.oversample_neighbours(df, "y", "id", ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
