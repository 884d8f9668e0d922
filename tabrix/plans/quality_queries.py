"""Registered data-quality queries (``dq.*``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.operators import quality as Q
from tabrix.operators.contract import QualityRules, SumCheck, TableContract, TemporalCheck
from tabrix.plans.common import DIRTY_ORDERS_SQL, dirty_orders, r6, table
from tabrix.plans.registry import query

ORDERS_CONTRACT = TableContract(
    columns=("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
             "o_orderpriority", "o_clerk"),
    numerical_columns=("o_orderkey", "o_custkey", "o_totalprice"),
    categorical_columns=("o_orderstatus", "o_orderpriority", "o_clerk"),
    target_column="o_orderstatus",
)
ORDERS_RULES = QualityRules(
    max_duplicate_ratio=0.02,
    critical_missing={"o_orderpriority": 0.2, "o_orderstatus": 0.05, "o_comment": 0.1},
    target_allowed_values=("F", "O"),
    numeric_bounds={"o_totalprice": (1000, 500000), "o_custkey": (1, None),
                    "o_shippriority": (0, 1)},
)

REPORT_COLS = ["dataset", "check_name", "column_name", "observed", "threshold", "passed"]


def _tidy(report: DataFrame) -> DataFrame:
    return report.select("dataset", "check_name", "column_name", r6("observed").alias("observed"),
                         "threshold", "passed")


def orders_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.validate(dirty_orders(spark, sf_dir), "orders", ORDERS_CONTRACT, ORDERS_RULES)


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with the sum of their line prices (pre-aggregated before the join)."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("line_total"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return o.join(li, o.o_orderkey == li.l_orderkey, "left").select(
        "o_orderkey", "line_total", "o_totalprice")


SUM_CONTRACT = TableContract(columns=("o_orderkey", "line_total", "o_totalprice"))
SUM_RULES = QualityRules(enforce_target_values=False, max_duplicate_ratio=0.0,
                         sum_check=SumCheck(parts=("line_total",), total="o_totalprice",
                                            max_ratio=0.01, tolerance=0.01))


def sum_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.value_checks(order_totals(spark, sf_dir), "order_totals", SUM_CONTRACT, SUM_RULES)


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey, "left").select("l_orderkey", "o_orderdate",
                                                                    "l_shipdate")


TEMPORAL_CONTRACT = TableContract(columns=("l_orderkey", "o_orderdate", "l_shipdate"))
TEMPORAL_RULES = QualityRules(enforce_target_values=False,
                              temporal_check=TemporalCheck("o_orderdate", "l_shipdate", 0.02))


def temporal_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.value_checks(shipments(spark, sf_dir), "shipments", TEMPORAL_CONTRACT, TEMPORAL_RULES)


TOKENS = "('', '?', 'n/a', 'na', 'none', 'null')"


def _miss(col: str) -> str:
    return (f"avg(CASE WHEN {col} IS NULL OR lower(regexp_replace({col}, '^\\s+|\\s+$', '', 'g')) "
            f"IN {TOKENS} THEN 1.0 ELSE 0.0 END)")


ORDERS_REPORT_BODY = f"""
SELECT 'orders' AS dataset, 'column_count' AS check_name, CAST(NULL AS VARCHAR) AS column_name,
       CAST(7.0 AS DOUBLE) AS observed, CAST(7.0 AS DOUBLE) AS threshold, true AS passed
UNION ALL SELECT 'orders', 'missing_columns', NULL, CAST(1.0 AS DOUBLE), CAST(0.0 AS DOUBLE), false
UNION ALL SELECT 'orders', 'extra_columns', NULL, CAST(1.0 AS DOUBLE), CAST(0.0 AS DOUBLE), true
UNION ALL SELECT 'orders', 'missing_numerical_columns', NULL, CAST(0.0 AS DOUBLE), CAST(0.0 AS DOUBLE), true
UNION ALL SELECT 'orders', 'missing_categorical_columns', NULL, CAST(1.0 AS DOUBLE), CAST(0.0 AS DOUBLE), false
UNION ALL SELECT 'orders', 'missing_ratio', 'o_comment', NULL, CAST(0.1 AS DOUBLE), false
UNION ALL SELECT 'orders', 'missing_ratio', 'o_orderpriority', round(m, 6), CAST(0.2 AS DOUBLE), m <= 0.2
  FROM (SELECT {_miss('o_orderpriority')} AS m FROM dirty_orders)
UNION ALL SELECT 'orders', 'missing_ratio', 'o_orderstatus', round(m, 6), CAST(0.05 AS DOUBLE), m <= 0.05
  FROM (SELECT {_miss('o_orderstatus')} AS m FROM dirty_orders)
UNION ALL SELECT 'orders', 'invalid_target_values', 'o_orderstatus', CAST(n AS DOUBLE), CAST(0.0 AS DOUBLE), n = 0
  FROM (SELECT count(DISTINCT CASE WHEN upper(o_orderstatus) NOT IN ('F', 'O')
                                   THEN upper(o_orderstatus) END) AS n FROM dirty_orders)
UNION ALL SELECT 'orders', 'below_min', 'o_totalprice', CAST(n AS DOUBLE), CAST(1000.0 AS DOUBLE), n = 0
  FROM (SELECT count(*) FILTER (WHERE o_totalprice < 1000) AS n FROM dirty_orders)
UNION ALL SELECT 'orders', 'above_max', 'o_totalprice', CAST(n AS DOUBLE), CAST(500000.0 AS DOUBLE), n = 0
  FROM (SELECT count(*) FILTER (WHERE o_totalprice > 500000) AS n FROM dirty_orders)
UNION ALL SELECT 'orders', 'below_min', 'o_custkey', CAST(n AS DOUBLE), CAST(1.0 AS DOUBLE), n = 0
  FROM (SELECT count(*) FILTER (WHERE o_custkey < 1) AS n FROM dirty_orders)
UNION ALL SELECT 'orders', 'duplicate_ratio', NULL, round((r - d) / r, 6), CAST(0.02 AS DOUBLE), (r - d) / r <= 0.02
  FROM (SELECT CAST(sum(n) AS DOUBLE) AS r, CAST(count(*) AS DOUBLE) AS d FROM (
          SELECT count(*) AS n FROM dirty_orders
          GROUP BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                   o_orderpriority, o_totalprice_txt))
"""

SUM_REPORT_BODY = """
SELECT 'order_totals' AS dataset, 'sum_mismatch' AS check_name, 'o_totalprice' AS column_name,
       round(m, 6) AS observed, CAST(0.01 AS DOUBLE) AS threshold, m <= 0.01 AS passed
FROM (
  SELECT avg(CASE WHEN coalesce(abs(t.line_total - o.o_totalprice) > CAST(0.01 AS DOUBLE), true) THEN 1.0 ELSE 0.0 END) AS m
  FROM orders o LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS line_total
                           FROM lineitem GROUP BY l_orderkey) t ON o.o_orderkey = t.l_orderkey
)
"""

TEMPORAL_REPORT_BODY = """
SELECT 'shipments' AS dataset, 'temporal_order' AS check_name, 'l_shipdate' AS column_name,
       round(m, 6) AS observed, CAST(0.02 AS DOUBLE) AS threshold, m <= 0.02 AS passed
FROM (
  SELECT avg(CASE WHEN coalesce(l.l_shipdate < o.o_orderdate, false) THEN 1.0 ELSE 0.0 END) AS m
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
)
"""


@query("dq_orders_report", sql=f"WITH {DIRTY_ORDERS_SQL} {ORDERS_REPORT_BODY}")
def dq_orders_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidy(orders_report(spark, sf_dir))


@query("dq_invalid_values", sql=f"""
WITH {DIRTY_ORDERS_SQL}
SELECT DISTINCT upper(o_orderstatus) AS invalid_value FROM dirty_orders
WHERE upper(o_orderstatus) NOT IN ('F', 'O')
""")
def dq_invalid_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.invalid_values(dirty_orders(spark, sf_dir), "o_orderstatus", ("F", "O"))


@query("dq_sum_mismatch", sql=SUM_REPORT_BODY)
def dq_sum_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidy(sum_report(spark, sf_dir))


@query("dq_temporal_order", sql=TEMPORAL_REPORT_BODY)
def dq_temporal_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tidy(temporal_report(spark, sf_dir))


@query("dq_summary", sql=f"""
WITH {DIRTY_ORDERS_SQL},
r AS ({ORDERS_REPORT_BODY} UNION ALL {SUM_REPORT_BODY} UNION ALL {TEMPORAL_REPORT_BODY}),
g AS (
  SELECT dataset, bool_and(passed) AS status, count(*) AS n_checks,
         count(*) FILTER (WHERE NOT passed) AS n_failed
  FROM r GROUP BY dataset
  UNION ALL
  SELECT '__all__', coalesce(bool_and(passed), false), count(*), count(*) FILTER (WHERE NOT passed)
  FROM r
)
SELECT dataset, status, n_checks, n_failed FROM g
""")
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = orders_report(spark, sf_dir).unionByName(sum_report(spark, sf_dir)) \
        .unionByName(temporal_report(spark, sf_dir))
    return Q.summarize(report)


@query("dq_orders_types", sql="""
SELECT 'orders' AS dataset, 'mistyped_numerical_columns' AS check_name, NULL AS column_name, CAST(2.0 AS DOUBLE) AS observed,
       CAST(0.0 AS DOUBLE) AS threshold, false AS passed FROM (SELECT count(*) FROM orders)
UNION ALL
SELECT 'orders', 'mistyped_categorical_columns', NULL, CAST(1.0 AS DOUBLE), CAST(0.0 AS DOUBLE), false FROM (SELECT count(*) FROM orders)
""")
def dq_orders_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles against types: a number column read as text, a text column, and a number among the categories."""
    orders = dirty_orders(spark, sf_dir)
    contract = TableContract(columns=tuple(orders.columns), target_column="o_orderstatus",
                             numerical_columns=("o_orderkey", "o_totalprice", "o_totalprice_txt", "o_orderpriority"),
                             categorical_columns=("o_orderstatus", "o_custkey", "o_clerk"))
    rules = QualityRules(check_types=True, target_allowed_values=("F", "O"))
    return _tidy(Q.validate(orders, "orders", contract, rules).where(F.col("check_name").startswith("mistyped_")))


@query("inputs_report", sql="""
SELECT 'orders' AS dataset, 'input_not_empty' AS check_name, NULL AS column_name, CAST(count(*) > 0 AS DOUBLE) AS observed,
       CAST(1.0 AS DOUBLE) AS threshold, count(*) > 0 AS passed FROM orders
UNION ALL SELECT 'events', 'input_not_empty', NULL, CAST(count(*) > 0 AS DOUBLE), CAST(1.0 AS DOUBLE), count(*) > 0 FROM events
UNION ALL SELECT 'returns', 'input_exists', NULL, CAST(0.0 AS DOUBLE), CAST(1.0 AS DOUBLE), false
""")
def inputs_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which required inputs exist and have rows (one of the three does not exist)."""
    from tabrix.sources import io as IO

    names = ("orders", "events", "returns")
    return _tidy(IO.require_inputs(spark, {n: f"{sf_dir.rstrip('/')}/{n}.parquet" for n in names}))
