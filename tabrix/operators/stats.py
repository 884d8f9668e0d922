"""Exact column statistics that never gather or shuffle a whole column.

* ``order_statistics`` – exact j-th smallest values per column. A sketch
  (``percentile_approx`` over a grid of ``GRID`` steps, merged map-side) gives each
  wanted rank a bracket of two values. One grouped count then tells how many values
  lie below the bracket and counts the distinct values inside; everything else is
  summed map-side. Only the bracket (about ``3 / GRID`` of a column, each distinct
  value once per task) is shuffled and put in order. The counts show whether the
  rank lies in its bracket; where a sketch missed, the bracket is opened wholly, so
  the result never rests on the sketch.
* ``exact_quantiles`` – interpolated percentiles (same definition as Spark's
  ``percentile`` / pandas ``median``) from two order statistics each.
* ``column_modes`` – most frequent value per column, ties to the smallest, NULL
  skipped: one unpivot + ``groupBy(column, value).count()`` + ``min_by``.

All return small DataFrames (one row per column / rank / quantile) that callers may
collect: their size is bounded by the number of columns x probabilities.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.functions.nulls import quoted
from tabrix.operators.prefix import running
from tabrix.session import written

#: Steps of the sketched grid; the sketch itself is eight times finer.
GRID = 256


def _long_form(df: DataFrame, cols: Sequence[str], cast: str) -> DataFrame:
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), quoted(c).cast(cast).alias("value")) for c in cols
    ])).alias("s")).select("s.column", "s.value")
    if cast == "double":
        stacked = stacked.where(~F.isnan("value"))
    return stacked.where(F.col("value").isNotNull())


def sketch(long: DataFrame) -> DataFrame:
    """``(column, n, grid)`` of ``(column, value)`` rows: counts and ``GRID + 1`` approximate percentiles."""
    steps = [i / GRID for i in range(GRID + 1)]
    return long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("value", steps, 8 * GRID).alias("grid"))


def order_statistics(long: DataFrame, targets: DataFrame, sketched: DataFrame) -> DataFrame:
    """``(column, j, value)``: for each target ``(column, j)`` the value with ``j`` values before it (from 0).

    ``long`` has ``(column, value)`` without NULL and NaN, of a type that orders;
    ``sketched`` is its ``sketch``. Targets and sketches have a row per column and
    rank, a proven bound: they are broadcast.
    """
    at = F.col("j") * GRID / F.col("n")
    low = F.get("grid", F.floor(at).cast("int") - 1)  # NULL: open
    high = F.get("grid", F.ceil(at).cast("int") + 1)
    ranked = targets.join(F.broadcast(sketched), "column")
    brackets = written(ranked.select("column", "j", low.alias("low"), high.alias("high")).distinct(), "quantile-brackets")
    found = None
    while True:
        # one row per value inside a bracket; the values below it are one more, those above none
        reach = long.join(F.broadcast(brackets), "column").where(F.col("high").isNull() | (F.col("value") <= F.col("high")))
        inside = F.col("low").isNull() | (F.col("value") >= F.col("low"))
        counts = reach.groupBy("column", "j", F.when(inside, F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("c"))
        counts = written(counts, "quantile-counts")
        below = counts.where("value IS NULL").select("column", "j", F.col("c").alias("below"))
        run = running(counts.where("value IS NOT NULL"), ["value"], [("cum", "sum", "c")], partition_by=["column", "j"])
        run = run.join(F.broadcast(below), ["column", "j"], "left").withColumn("cum", F.col("cum") + F.coalesce("below", F.lit(0)))
        hits = run.where((F.col("cum") - F.col("c") <= F.col("j")) & (F.col("j") < F.col("cum"))).select("column", "j", "value")
        hits = written(hits, "order-statistics")
        found = hits if found is None else found.unionByName(hits)
        missed = written(brackets.where("low IS NOT NULL OR high IS NOT NULL").join(F.broadcast(hits), ["column", "j"], "left_anti"),
                         "quantile-missed")
        if missed.isEmpty():
            return found
        none = F.lit(None).cast(brackets.schema["low"].dataType)
        brackets = missed.withColumns({"low": none, "high": none})


def quantiles_of(long: DataFrame, probs: Sequence[float]) -> DataFrame:
    """Rows ``(column, prob, value)`` of long-form ``(column, value)`` doubles; ``long`` is read twice."""
    sketched = written(sketch(long), "quantile-sketch")
    positions = sketched.select(
        "column", F.explode(F.array(*[F.struct(F.lit(float(p)).alias("prob"), ((F.col("n") - 1) * F.lit(float(p))).alias("h"))
                                      for p in probs])).alias("q")).select("column", "q.prob", "q.h")
    lo, hi = F.floor("h"), F.ceil("h")
    wanted = positions.select("column", F.explode(F.array(lo, hi)).alias("j")).distinct()
    stats = order_statistics(long, wanted, sketched)
    both = positions.join(F.broadcast(stats.withColumnsRenamed({"j": "lo_j", "value": "lo_v"})), "column") \
        .where(lo == F.col("lo_j")).join(F.broadcast(stats.withColumnsRenamed({"j": "hi_j", "value": "hi_v"})), "column") \
        .where(hi == F.col("hi_j"))
    value = F.when(lo == hi, F.col("lo_v")).otherwise((hi - F.col("h")) * F.col("lo_v") + (F.col("h") - lo) * F.col("hi_v"))
    return both.select("column", "prob", value.alias("value"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Rows ``(column, prob, value)``; NULL/NaN ignored; no rows for an all-NULL column."""
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, prob double, value double")
    return quantiles_of(_long_form(df, cols, "double"), probs)


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows ``(column, value)``: the most frequent non-NULL value (as text), ties
    broken to the smallest value; columns with no value are absent."""
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string")
    counts = _long_form(df, cols, "string").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("value"))
