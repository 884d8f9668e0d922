import pytest
from pyspark.sql import functions as F

from tabrix.operators import clean as C


def test_rename_and_normalise_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`capital-gains` long, `Policy Deductable` long, x long")
    out = C.rename_columns(df, {"Policy Deductable": "policy_deductible"})
    assert out.columns == ["capital_gains", "policy_deductible", "x"]
    with pytest.raises(ValueError):
        C.rename_columns(spark.createDataFrame([(1, 2)], "`a-b` long, a_b long"), {})


def test_trim_map_tokens(spark):
    df = spark.createDataFrame([("  m ", " yes", "?"), ("Female", "n", " N/A "), (None, "Maybe", "x")],
                               "insured_sex string, property_damage string, other string")
    out = C.null_tokens(C.map_categories(C.trim_strings(df)))
    got = [tuple(r) for r in out.collect()]
    assert got == [("MALE", "YES", None), ("FEMALE", "NO", None), (None, "MAYBE", "x")]
    legacy = C.map_categories(df.select("insured_sex"), legacy_nan_text=True).collect()
    assert legacy[2][0] == "NAN"


def test_dedup_and_empty_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (None, "b")], "x long, y string")
    out = C.drop_empty_rows(C.drop_duplicates(df))
    assert sorted(out.collect(), key=str) == sorted([(1, "a"), (None, "b")], key=str)


@pytest.mark.parametrize("good,expect", [(89, False), (90, True), (91, True)])
def test_coerce_threshold(spark, good, expect):
    data = [(str(i),) for i in range(good)] + [("x",)] * (100 - good)
    df = spark.createDataFrame(data, "s string")
    assert (C.fit_coerce_numeric(df) == ["s"]) is expect


def test_coerce_rejects_spark_only_literals(spark):
    df = spark.createDataFrame([("1d",), ("2",), (" 3.5 ",), ("1e3",), ("nan",)], "s string")
    vals = [r[0] for r in C.apply_coerce_numeric(df, ["s"]).collect()]
    assert vals == [None, 2.0, 3.5, 1000.0, None]


def test_impute_median_mode_unknown(spark):
    df = spark.createDataFrame(
        [(1.0, "b", None), (2.0, "a", None), (None, None, None), (10.0, "b", None), (3.0, "a", None)],
        "x double, c string, empty string")
    stats = C.fit_impute(df)
    assert stats.medians["x"] == 2.5
    assert stats.modes["c"] == "a"  # tie a/b -> smallest
    assert stats.modes["empty"] == "UNKNOWN"
    out = C.apply_impute(df, stats).collect()
    assert out[2]["x"] == 2.5 and out[2]["c"] == "a" and out[0]["empty"] == "UNKNOWN"


def test_median_matches_percentile(spark):
    df = spark.range(0, 1001).select((F.col("id") * 7 % 113).cast("double").alias("v"),
                                     (F.col("id") % 5).cast("double").alias("w"))
    from tabrix.operators.stats import exact_quantiles

    got = {(r["column"], r["prob"]): r["value"]
           for r in exact_quantiles(df, ["v", "w"], [0.25, 0.5, 0.9]).collect()}
    ref = df.agg(F.percentile("v", [0.25, 0.5, 0.9]).alias("v"),
                 F.percentile("w", [0.25, 0.5, 0.9]).alias("w")).first()
    for c in ("v", "w"):
        for i, p in enumerate([0.25, 0.5, 0.9]):
            assert abs(got[(c, p)] - ref[c][i]) < 1e-9


def test_label_encoder_and_unseen(spark):
    train = spark.createDataFrame([("N",), ("Y",), ("N",)], "t string")
    labels = C.fit_label_encoder(train, "t")
    assert labels == ["N", "Y"]
    enc = C.apply_label_map(train, "t", labels)
    assert [r[0] for r in enc.collect()] == [0, 1, 0]
    test = spark.createDataFrame([("Y",), ("MAYBE",)], "t string")
    with pytest.raises(C.UnknownLabelError, match="MAYBE"):
        C.apply_label_map(test, "t", labels)


def test_wide_cleaning_chain_plans_with_constraint_inference_on(spark):
    """A NULL filter over all 40 columns above a projection of 40 computed
    columns: constraint inference would double its set per alias (2^40)."""
    spark.conf.set("spark.sql.constraintPropagation.enabled", "true")
    cols = [f"c{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(f" v{i} " for i in range(40)), tuple([None] * 40)],
                               ", ".join(f"{c} string" for c in cols))
    d = C.null_tokens(C.map_categories(C.trim_strings(C.rename_columns(df, {})), {}), ["?"])
    d = C.drop_null_target(C.drop_empty_rows(C.drop_duplicates(d)), "c0")
    assert spark.conf.get("spark.sql.constraintPropagation.enabled") == "true"
    assert [r["c5"] for r in d.collect()] == ["v5"]
