"""Registered cleaning, text and date queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.functions import dates as D
from tabrix.functions import text as X
from tabrix.operators import clean as C
from tabrix.operators.parallel import spread
from tabrix.session import materialize
from tabrix.plans.common import DIRTY_ORDERS_SQL, dirty_orders, r6, table
from tabrix.plans.registry import query
from tabrix.plans.sqlbits import TOKENS, normalize, safe_double, strip

STATUS_MAP = {"o_orderstatus": {"f": "FILLED", "o": "OPEN"}}


def cleaned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = C.trim_strings(dirty_orders(spark, sf_dir))
    d = C.map_categories(d, STATUS_MAP)
    d = C.null_tokens(d)
    # several fit jobs read the deduplicated frame: materialise it once
    d = materialize(C.drop_empty_rows(C.drop_duplicates(d)))
    d = C.coerce_numeric(d, target="o_orderstatus")
    return C.impute(d)


@query("clean_orders", sql=f"""
WITH {DIRTY_ORDERS_SQL},
s AS (
  SELECT o_orderkey, o_custkey,
         CASE lower({strip('o_orderstatus')}) WHEN 'f' THEN 'FILLED' WHEN 'o' THEN 'OPEN'
              ELSE upper({strip('o_orderstatus')}) END AS o_orderstatus,
         o_totalprice, o_orderdate,
         {strip('o_orderpriority')} AS o_orderpriority,
         {strip('o_totalprice_txt')} AS o_totalprice_txt
  FROM dirty_orders),
n AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN lower(o_orderstatus) IN {TOKENS} THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate,
         CASE WHEN lower(o_orderpriority) IN {TOKENS} THEN NULL ELSE o_orderpriority END AS o_orderpriority,
         CASE WHEN lower(o_totalprice_txt) IN {TOKENS} THEN NULL ELSE o_totalprice_txt END AS o_totalprice_txt
  FROM s),
d AS (SELECT DISTINCT * FROM n),
c AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
             {safe_double('o_totalprice_txt')} AS o_totalprice_txt FROM d),
m AS (SELECT median(o_totalprice_txt) AS med FROM c),
p AS (SELECT o_orderpriority AS mode_p FROM c WHERE o_orderpriority IS NOT NULL
      GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority LIMIT 1)
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, o_orderdate,
       coalesce(o_orderpriority, p.mode_p) AS o_orderpriority,
       round(coalesce(o_totalprice_txt, m.med), 6) AS o_totalprice_txt
FROM c CROSS JOIN m CROSS JOIN p
""")
def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = cleaned_orders(spark, sf_dir)
    return d.select("o_orderkey", "o_custkey", "o_orderstatus", r6("o_totalprice").alias("o_totalprice"),
                    "o_orderdate", "o_orderpriority", r6("o_totalprice_txt").alias("o_totalprice_txt"))


@query("label_encode", sql="""
SELECT o_orderkey, o_orderpriority,
       CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS priority_idx
FROM orders
""")
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return C.apply_label_table(o, "o_orderpriority", C.fit_label_table(o, "o_orderpriority"), out="priority_idx")


@query("text_normalize_documents", sql=f"""
SELECT doc_id, {normalize('text')} AS text_norm FROM documents
""")
def text_normalize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", X.normalize_expr(F.col("text")).alias("text_norm"))


@query("text_normalize_part", sql=f"""
SELECT p_partkey, {normalize('p_name')} AS p_name, {normalize('p_brand')} AS p_brand,
       {normalize('p_type')} AS p_type, p_size, round(p_retailprice, 6) AS p_retailprice
FROM part
""")
def text_normalize_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    out = X.normalize_columns(p, ["p_name", "p_brand", "p_type", "p_comment"])
    return out.withColumn("p_retailprice", r6("p_retailprice"))


@query("text_combine_part", sql=f"""
SELECT p_partkey, p_size, round(p_retailprice, 6) AS p_retailprice,
       {strip("concat_ws(' ', coalesce(p_name, ''), coalesce(p_brand, ''), coalesce(p_type, ''))")}
         AS combined_text
FROM part
""")
def text_combine_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    out = X.combine_columns(p, ["p_name", "p_brand", "p_type", "p_comment"], "combined_text")
    return out.withColumn("p_retailprice", r6("p_retailprice"))


@query("date_enrich", sql="""
SELECT l.l_orderkey, l.l_linenumber,
       CAST(year(o.o_orderdate) AS INTEGER) AS o_orderdate_year,
       CAST(month(o.o_orderdate) AS INTEGER) AS o_orderdate_month,
       CAST(day(o.o_orderdate) AS INTEGER) AS o_orderdate_day,
       CAST(year(l.l_shipdate) AS INTEGER) AS l_shipdate_year,
       CAST(month(l.l_shipdate) AS INTEGER) AS l_shipdate_month,
       CAST(day(l.l_shipdate) AS INTEGER) AS l_shipdate_day,
       CAST(floor((epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate)) / 86400000000.0) AS INTEGER)
         AS order_to_ship_days
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def date_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left").drop("o_orderkey")
    return D.enrich_dates(j, ["o_orderdate", "l_shipdate"], ("o_orderdate", "l_shipdate"),
                          "order_to_ship_days")


DATE_TEXT_SQL = """
SELECT o_orderkey,
       CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%m/%d/%Y')
                            WHEN '5-LOW' THEN 'not a date'
                            WHEN '2-HIGH' THEN ' ' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date_text
FROM orders
"""


@query("date_parse", sql=f"""
WITH t AS ({DATE_TEXT_SQL}), p AS (
  SELECT o_orderkey, coalesce(
     try_strptime({strip('order_date_text')}, '%Y-%m-%d %H:%M:%S'),
     try_strptime({strip('order_date_text')}, '%Y-%m-%d'),
     try_strptime({strip('order_date_text')}, '%m/%d/%Y'),
     try_strptime({strip('order_date_text')}, '%Y/%m/%d'),
     try_strptime({strip('order_date_text')}, '%d-%m-%Y')) AS order_date
  FROM t)
SELECT o_orderkey, order_date,
       CAST(year(order_date) AS INTEGER) AS order_date_year,
       CAST(month(order_date) AS INTEGER) AS order_date_month,
       CAST(day(order_date) AS INTEGER) AS order_date_day
FROM p
""")
def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    txt = o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit("not a date"))
        .when(F.col("o_orderpriority") == "2-HIGH",
              F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date_text"))
    ts = D.parse_date(F.col("order_date_text"))
    return txt.select("o_orderkey", ts.alias("order_date"),
                      *D.date_parts(ts, "order_date"))


@query("rename_drop_orders", sql="""
SELECT o_orderkey AS order_key, o_orderstatus AS order_status, round(o_totalprice, 6) AS total_price
FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')
""")
def rename_drop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd names made regular; rows with nothing but a key, and rows without their target, dropped."""
    empty, unlabelled = F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority") == "4-NOT SPECIFIED"
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order-Key"), F.when(~(empty | unlabelled), F.col("o_orderstatus")).alias("status"),
        F.when(~empty, r6("o_totalprice")).alias(" Total Price "))
    d = C.rename_columns(o, {"status": "Order Status"})
    return C.drop_null_target(C.drop_empty_rows(d, ["order_key"]), "order_status")


@query("csv_orders", sql="""
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE round(o_totalprice, 6) END AS o_totalprice,
       CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '3-MEDIUM' THEN '?' ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders written as CSV with missing-value tokens and read back: tokens NULL, columns typed by what is left."""
    from tabrix.session import scratch_path
    from tabrix.sources import io as IO

    priority = F.col("o_orderpriority")
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(priority == "5-LOW", "N/A").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(priority == "1-URGENT", "nan").when(priority == "3-MEDIUM", "?").otherwise(priority).alias("o_orderpriority"))
    path = scratch_path(spark, "orders-csv")
    IO.write_table(text, path, fmt="csv")
    back = IO.read_table(spark, path, fmt="csv", label="orders")
    return back.select("o_orderkey", r6("o_totalprice").alias("o_totalprice"), "o_orderpriority")


@query("lemmatize_documents", sql="""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM documents)
SELECT doc_id, array_to_string(list_transform(w, lambda x: CASE WHEN length(x) > 4 AND x LIKE '%ing' THEN left(x, length(x) - 3) ELSE x END), ' ') AS lemmas
FROM t
""")
def lemmatize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lemmas by a table taken from the corpus: each longer word in -ing without that ending."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", X.tokenize(F.coalesce("text", F.lit(""))).alias("words")))
    word = F.col("token")
    lemmas = d.select(F.explode("words").alias("token")).where(word.endswith("ing") & (F.length(word) > 4)).distinct()
    lemmas = lemmas.select("token", F.expr("left(token, length(token) - 3)").alias("lemma"))
    out = X.lemmatize_join(materialize(d), "doc_id", "words", lemmas)
    return out.select("doc_id", F.array_join("words", " ").alias("lemmas"))


@query("feature_frame_part", sql=f"""
SELECT p_partkey, round(p_retailprice, 6) AS p_retailprice,
       {strip("concat_ws(' ', coalesce(p_name, ''), coalesce(p_type, ''))")} AS combined_text, p_brand, p_size,
       'p_partkey,p_retailprice' AS numeric_columns, 'p_brand' AS categorical_columns
FROM part
""")
def feature_frame_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature frame (text combined, target last) beside the roles that its manifest lists."""
    from tabrix.operators import features as FE

    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", r6("p_retailprice").alias("p_retailprice"))
    frame = FE.feature_frame(p, "p_size", ["p_name", "p_type", "p_comment"])
    roles = FE.manifest(frame, "p_size")
    return frame.select("*", *[F.lit(",".join(roles[c])).alias(c) for c in ("numeric_columns", "categorical_columns")])
