import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabrix.operators.prefix import row_positions, running


def _frame(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        # one hot group holding about a third of all rows
        g = "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", "c", None])
        v = None if rnd.random() < 0.1 else rnd.randint(-50, 50)
        data.append((i, g, float(rnd.randint(0, 200)), v))
    return spark.createDataFrame(data, "id long, g string, o double, v long")


def test_running_matches_plain_window(spark):
    df = _frame(spark)
    keys = ["o", "id"]
    out = running(df, keys, [("s", "sum", "v"), ("mx", "max", "v"), ("mn", "min", "v"),
                             ("lst", "last", "v"), ("c", "count", "v")],
                  partition_by=["g"], inclusive=False, num_bins=7)
    w = Window.partitionBy("g").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    ref = df.select("id", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("s2"),
                    F.max("v").over(w).alias("mx2"), F.min("v").over(w).alias("mn2"),
                    F.last("v", True).over(w).alias("lst2"),
                    F.coalesce(F.count("v").over(w), F.lit(0)).alias("c2"))
    j = out.join(ref, "id")
    bad = j.where(~(F.col("s").eqNullSafe(F.col("s2")) & F.col("mx").eqNullSafe(F.col("mx2"))
                    & F.col("mn").eqNullSafe(F.col("mn2")) & F.col("lst").eqNullSafe(F.col("lst2"))
                    & F.col("c").eqNullSafe(F.col("c2"))))
    assert j.count() == 3000
    assert bad.count() == 0


def test_row_positions_equal_row_number(spark):
    df = _frame(spark, 2000, 2)
    p = row_positions(df, ["o", "id"], ["g"], num_bins=5)
    w = Window.partitionBy("g").orderBy("o", "id")
    ref = df.select("id", F.row_number().over(w).alias("rn"))
    assert p.join(ref, "id").where("pos != rn").count() == 0


def test_no_single_partition_window(spark):
    df = _frame(spark, 500, 3)
    plan = running(df, ["o", "id"], [("s", "sum", "v")])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_hot_group_is_spread_over_bins(spark):
    from tabrix.operators.prefix import range_bins
    from tabrix.operators.split import _hash_cols

    # one class holds 40% of the rows; its hash-ordered rows must not land in one bin
    df = spark.range(20000).select("id", F.when(F.col("id") % 5 < 2, "hot")
                                   .otherwise(F.concat(F.lit("c"), (F.col("id") % 97).cast("string")))
                                   .alias("cls"))
    binned = range_bins(_hash_cols(df, "id", 42), F.col("__hp").cast("double"), 16, out="b")
    per_bin = [r["count"] for r in binned.where("cls = 'hot'").groupBy("b").count().collect()]
    assert len(per_bin) >= 12
    assert max(per_bin) <= 0.15 * 8000
