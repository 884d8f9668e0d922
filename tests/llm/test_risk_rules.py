import math
import re
from collections import Counter

from llm_data import frame, space_words
from pyspark.sql import functions as F

from tabrix.llm import quality


def plain(s):
    s = s or ""
    w = space_words(s)
    windows = [tuple(w[i: i + 8]) for i in range(len(w) - 7)]
    seen, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in s.split("\n") if space_words(x)]
    base = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", s)), len(lines) - len(set(lines)), len(covered), base)


def test_measures_equal_brute_force(spark):
    docs = frame(spark).withColumn("N_WORDS", F.lit("clash")).withColumn("measures", F.lit("mine"))
    docs = docs.unionByName(docs.where("doc_id = 27"))
    out = quality.measure(docs).collect()
    assert {r.measures for r in out} == {"mine"}
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted([tuple(r[c] for c in cols) for r in out]) == sorted(plain(r.text) for r in docs.collect())
    assert quality.measure(frame(spark, [])).count() == 0


def test_binomial_tail_is_exact(spark):
    rows = [(n, k, a) for n in (1, 20, 217, 900) for k in (0, 1, 3, 8) for a in (0.02, 0.1)]
    df = spark.createDataFrame(rows, "n bigint, k bigint, a double")
    for a in (0.02, 0.1):
        for r in df.where(F.col("a") == a).withColumn("p", quality._binomial_tail(F.col("n"), F.col("k"), a)).collect():
            exact = sum(math.comb(r.n, i) * a**i * (1 - a) ** (r.n - i) for i in range(r.k + 1))
            assert r.p == 1.0 if r.k >= r.n * a else abs(r.p - exact) < 1e-9


def test_certified_steps_stop_at_the_first_failure(spark):
    # a: 3 of 1000 go at step 2, 40 more at step 5; b: too few labels; NULL: none goes
    rows = [("a", 2)] * 3 + [("a", 5)] * 40 + [("a", None)] * 957 + [("b", None)] * 50 + [(None, None)] * 400
    out = quality.certified_steps(spark.createDataFrame(rows, "s string, step int"), "s", "step")
    got = {r.stratum: (r.n_good, r.last_step) for r in out.collect()}
    assert got == {"a": (1000, 4), "b": (50, -2), None: (400, (1 << 20) - 1)}


def test_verdicts(spark):
    good = [(i, "word " * 0 + " ".join(f"w{i}x{j}" for j in range(30)), "en", "s", 1) for i in range(400)]
    bad = [(1000 + i, " ".join(f"w{i}x{j}***" for j in range(30)), "en", "s", 1) for i in range(20)]
    other = [(2000, " ".join(f"w{j}***" for j in range(30)), "xx", "s", 1), (2001, None, None, None, None)]
    docs = frame(spark, good + bad + other)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)] + [(1000, 0, 0), (None, 1, 0), (0, 0, 0), (0, 1, 1)], "doc_id bigint, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality.judge(quality.measure(docs), labels, "doc_id", "lang").collect()}
    assert all(kept[i] for i in range(400)) and not any(kept[1000 + i] for i in range(20))
    assert kept[2000] and not kept[2001]  # nothing is certified for xx; no words fails the base rule
    none = quality.judge(quality.measure(docs), labels.limit(0), "doc_id", "lang")
    assert sum(r.kept for r in none.collect()) == 421
    plan = none._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_any_number_of_strata(spark, monkeypatch):
    # 10,100 strata with one good label each, and three with enough labels to certify steps
    rows = [(i, f"x{i}", 30, 0.0) for i in range(10_100)]
    rows += [(20_000 + i, s, 30, 0.0) for s, at in (("en", 0), ("fr", 2000), (None, 4000)) for i in range(at, at + 1000)]
    rows += [(30_000 + i, s, 30, 90.0) for i, s in enumerate(("en", "fr", None, "x1", "new"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, n_words int, n_symbols double").withColumns(
        {"n_shouts": F.lit(0), "n_dup_lines": F.lit(0), "n_lines": F.lit(1), "base_failed": F.col("doc_id") == 5, "cut": F.lit("mine")})
    labels = docs.where("doc_id < 30000").select("doc_id", F.lit(1).alias("quality"))
    for most in (quality.MAX_STRATA, 2):  # cutoffs as one map, and joined
        monkeypatch.setattr(quality, "MAX_STRATA", most)
        out = quality.judge(docs, labels, "doc_id", "lang")
        assert out.columns == [*docs.columns, "kept"]
        got = out.collect()
        assert len(got) == len(rows) and {r.cut for r in got} == {"mine"}
        assert {r.doc_id for r in got if not r.kept} == {5, 30_000, 30_001, 30_002}
