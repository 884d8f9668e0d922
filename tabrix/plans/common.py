"""Table loading and the dirty-data views shared by the registered queries.

The driver tables hold no NULLs and no duplicate rows, so dirt is injected by
expressions written identically in Spark and in the SQL oracle. Nothing is
filtered away: every query reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """Round a double to 6 digits (same on the SQL side)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _dirt(o: DataFrame) -> DataFrame:
    return o.select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lower("o_orderstatus"), F.lit(" ")))
        .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        "o_orderdate",
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(" N/A "))
        .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when((F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderstatus") == "O"),
               F.lit("unknown"))
        .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice_txt"),
    )


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with placeholder tokens, mixed case and padding, a numeric text
    column ~93 % parsable, and every urgent pending order repeated once."""
    o = table(spark, sf_dir, "orders")
    base = _dirt(o)
    dup = _dirt(o.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")))
    return base.unionByName(dup)


DIRTY_ORDERS_SQL = """
base_orders AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderstatus = 'F' THEN lower(o_orderstatus) || ' ' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' N/A ' ELSE o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN 'unknown'
              ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice_txt,
         o_orderpriority AS raw_priority, o_orderstatus AS raw_status
  FROM orders
),
dirty_orders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_totalprice_txt
  FROM base_orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_totalprice_txt
  FROM base_orders WHERE raw_priority = '1-URGENT' AND raw_status = 'P'
)
"""
