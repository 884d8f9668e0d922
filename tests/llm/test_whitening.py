"""Embedding whitening against numpy on the whole list and against exact whole numbers."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
from tabrix.llm.whitening import Moments, whiten

SCHEMA = "vec_id bigint, embedding array<float>"
SF = "/root/testdata/sf0.001"


def points_of(rows):
    """Usable rows on the grid: (vec_id, x)."""
    kept = []
    for i, v in rows:
        if v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        kept.append((i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)))
    return kept


def check(got, rows, weighted=False, components=16):
    """``got``: (vec_id, component, n, deviation, whitened, explained, identity_error) rows of the contract."""
    kept = points_of(rows)
    counts = Counter(x for _, x in kept)
    fit = list(counts)
    w = np.array([counts[x] if weighted else 1 for x in fit])
    n, sums = int(w.sum()), [sum(int(k) * x[j] for k, x in zip(w, fit, strict=True)) for j in range(len(fit[0]))]
    c = (np.array(fit, dtype=float) * n - np.array(sums, dtype=float)) / n
    cov = (c * w[:, None]).T @ c / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    k = int((e > 1e-12 * e[0]).sum())
    by_row = defaultdict(list)
    for r in got:
        by_row[r[0]].append(r)
    assert Counter(i for i, _ in kept) == {i: len(r) // k for i, r in by_row.items()}
    sign = np.ones(k)
    for i, x in kept:
        rest = sorted(by_row[i], key=lambda r: r[1])
        assert {r[1] for r in rest} == set(range(1, k + 1)) and {r[2] for r in rest} == {n}
        if sum(1 for j, _ in kept if j == i) > 1:
            continue
        assert {r[3] for r in rest} == {sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))}
        want = np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)]) @ v[:, :k] / np.sqrt(e[:k])
        have = np.array([r[4] for r in rest])
        if i == kept[0][0]:
            sign = np.where(np.sign(want) == np.sign(have), 1, -1)
        assert np.allclose(have, want * sign, atol=1e-7)
        assert np.allclose([r[5] for r in rest], e[:k] / np.trace(cov), rtol=1e-9)
        assert {r[6] for r in rest} == {rest[0][6]} and rest[0][6] < 1e-9
    return k


def digest_rows(df):
    from pyspark.sql import functions as F

    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("i", "c")
    out = df.select("vec_id", "n", "deviation", "identity_error", each)
    return [(r["vec_id"], r["i"] + 1, r["n"], int(r["deviation"]), r["c"]["whitened"], r["c"]["explained"], r["identity_error"]) for r in out.collect()]


def vectors(seed=3, n=150, d=7):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.1 * (j + 1)) for j in range(d)]) for i in range(n)]
    rows += [(1000 + i, rows[4][1]) for i in range(80)]  # a vector with a third of all rows
    rows += [(2000, None), (2001, [None] + [0.0] * (d - 1)), (2002, [float("nan")] * d), (2003, [float("inf")] * d),
             (2004, []), (2005, [1.0, 2.0]), (2006, [-0.015625] * d), (2007, [-0.0] * d)]
    return rows


@pytest.mark.parametrize("weights", ["one", "count"])
def test_against_numpy(spark, weights):
    rows = vectors()
    got = digest_rows(whiten(spark.createDataFrame(rows, SCHEMA), "embedding", weights=weights))
    same = [(i, v) for i, v in rows if v is None or len(v) == 7]  # other lengths go
    assert check(got, same, weighted=weights == "count") == 7


def test_query_over_the_whole_table(spark):
    df = entry.queries()["op11_multiplicity_whitening"](spark, SF)
    assert df.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
                         ("explained", "double"), ("identity_error", "double")]
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert check([tuple(r) for r in df.collect()], rows) == 16


def test_exact_beyond_64_bits():
    m = Moments(3, (2**61, -5))
    x = np.array([[2**60, 1], [0, -(2**60)]], dtype=np.int64)
    assert m.deviations(x) == [(3 * int(a) - 2**61) ** 2 + (3 * int(b) + 5) ** 2 for a, b in x.tolist()]


def test_edge_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whiten(empty, "embedding").count() == 0
    assert whiten(spark.createDataFrame([(1, None), (2, []), (None, [float("nan")])], SCHEMA), "embedding").count() == 0
    assert whiten(spark.createDataFrame([(1, [0.5, 1.0])] * 3, SCHEMA), "embedding").count() == 0  # one point: no variance
    flat = spark.createDataFrame([(1, [0.5, 1.0]), (None, [1.5, 1.0]), (None, [1.5, 1.0])], SCHEMA)
    out = whiten(flat, "embedding").collect()
    assert len(out) == 3 and all(len(r["whitened"]) == 1 for r in out)  # the constant dimension is no component
    assert sorted(r["whitened"][0] for r in out) == pytest.approx([-1, 1, 1])
    clash = flat.selectExpr("*", "'mine' AS n", "7 AS point", "8 AS `a.b`", "9 AS weight")
    out = whiten(clash, "embedding")
    assert sorted(out.columns) == sorted(["vec_id", "point", "a.b", "weight", "n", "deviation", "whitened", "explained", "identity_error"])
    assert {(r["n"], r["point"], r["weight"]) for r in out.collect()} == {(2, 7, 9)}
    huge = spark.createDataFrame([(1, [3e38, 0.0]), (2, [1.0, 2.0]), (3, [2.0, 5.0])], SCHEMA)
    assert {r["vec_id"] for r in whiten(huge, "embedding").collect()} == {2, 3}
