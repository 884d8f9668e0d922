"""Parallelism guard for CPU-heavy per-row steps.

A source with fewer input splits than the cluster has cores (one big Parquet
row group, a few large files) would run regex / tokenising work in a handful of
tasks. ``spread`` round-robins the (already projected) rows over
``defaultParallelism`` partitions only in that case; on a large input with many
splits it is a no-op, so it never adds a shuffle at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    sc = df.sparkSession.sparkContext
    target = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)
