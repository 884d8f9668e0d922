import datetime as dt

from pyspark.sql import functions as F

from tabrix.functions import dates as D
from tabrix.functions import text as X


def test_normalize_worked_example(spark):
    df = spark.createDataFrame([("Visit https://x.com NOW for the claim update!",), (None,)], "t string")
    out = [r[0] for r in df.select(X.normalize_expr(F.col("t"))).collect()]
    assert out == ["visit claim update", ""]
    legacy = df.select(X.normalize_expr(F.col("t"), legacy_nan_text=True)).collect()
    assert legacy[1][0] == "nan"


def test_normalize_keeps_repeats_and_lemmas(spark):
    df = spark.createDataFrame([("Cars and cars, www.a.b CARS",)], "t string")
    out = df.select(X.normalize_expr(F.col("t"), lemmas={"cars": "car"})).first()[0]
    assert out == "car car car"


def test_stopword_filter_is_hash_set(spark):
    df = spark.createDataFrame([("a b",)], "t string")
    plan = df.select(X.normalize_expr(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan.upper()


def test_combine_columns(spark):
    df = spark.createDataFrame([("a", None, "c", 1), (None, None, None, 2)],
                               "x string, y string, z string, k long")
    out = X.combine_columns(df, ["x", "y", "z", "missing"], "combined")
    assert out.columns == ["k", "combined"]
    assert [r[1] for r in out.collect()] == ["a  c", ""]
    none = X.combine_columns(df, ["missing"], "combined")
    assert [r["combined"] for r in none.collect()] == ["", ""]


def test_dates_parse_parts_diff(spark):
    df = spark.createDataFrame([("2020-03-01", "2020-02-28 23:00:00"), ("03/05/2021", "bad"),
                                (None, "2021-01-01")], "a string, b string")
    out = D.enrich_dates(df, ["a", "b"], ("b", "a"), "days").collect()
    assert out[0]["a_year"] == 2020 and out[0]["a_month"] == 3 and out[0]["a_day"] == 1
    # 2020-02-28 23:00 -> 2020-03-01 00:00 is 1 day 1 hour: floor -> 1
    assert out[0]["days"] == 1
    assert out[1]["a_month"] == 3 and out[1]["a_day"] == 5 and out[1]["b_year"] is None
    assert out[2]["days"] is None
    neg = spark.createDataFrame([(dt.datetime(2020, 1, 2, 12), dt.datetime(2020, 1, 1, 13))],
                                "a timestamp, b timestamp")
    assert neg.select(D.diff_days(F.col("a"), F.col("b"))).first()[0] == -1


def test_diff_days_ignores_session_time_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 3, 7, 12), dt.datetime(2020, 3, 8, 12))],
                               "a timestamp_ntz, b timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(D.diff_days(F.col("a"), F.col("b"))).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
