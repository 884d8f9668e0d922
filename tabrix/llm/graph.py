"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is joins and minima on edge rows: a node of any degree is summed
map-side and never collected, and the rows of hub nodes are joined where they lie
(``operators.keyed.join_unique``). Each step is written to the shared folder, which
bounds the lineage. Components longer than a star halve their depth per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.llm.common import staged
from tabrix.operators.keyed import hot_keys, join_unique


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with an edge to another; ``root`` is the smallest node reachable."""
    ends = edges.where(F.col(a) != F.col(b))
    now = staged(ends.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = join_unique(both.where("v > u"), low, ["u"], hot=hot_keys(both, ["u"])).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        now = staged(large.distinct(), "large-star")
        low = now.groupBy("u").agg(F.min("v").alias("m"))
        small = join_unique(now, low, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u != v")
        now = staged(small.distinct(), "small-star")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
