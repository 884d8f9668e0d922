"""Registered feature queries: one-hot, TF-IDF, scalers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.operators import features as FE
from tabrix.plans.common import r6, table
from tabrix.plans.registry import ORACLE_SQL, query

ONEHOT_COLS = ["o_orderstatus", "o_orderpriority"]


@query("onehot_orders", sql="""
WITH l AS (SELECT o_orderkey, 'o_orderstatus' AS column_name, o_orderstatus AS category FROM orders
           UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority FROM orders),
v AS (SELECT column_name, category,
             CAST(row_number() OVER (PARTITION BY column_name ORDER BY category) - 1 AS INTEGER) AS category_index
      FROM (SELECT DISTINCT column_name, category FROM l WHERE category IS NOT NULL))
SELECT l.o_orderkey, l.column_name, l.category, v.category_index
FROM l LEFT JOIN v ON l.column_name = v.column_name AND l.category = v.category
""")
def onehot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    vocab = FE.fit_one_hot(o, ONEHOT_COLS)
    return FE.one_hot_long(o, "o_orderkey", ONEHOT_COLS, vocab)


@query("onehot_pipeline_orders", sql=ORACLE_SQL["onehot_orders"])
def onehot_pipeline_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector blocks that the model pipeline's category stage gives, in long form."""
    from tabrix.operators.stages import vector_entries

    o = table(spark, sf_dir, "orders").select("o_orderkey", *ONEHOT_COLS)
    model = FE.one_hot_stages(ONEHOT_COLS)[0].fit(o)
    blocks = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("category"),
                                          vector_entries(F.col(f"{c}_ohe")).alias("entries")) for c in ONEHOT_COLS])).alias("b")
    one = F.get(F.filter("b.entries", lambda e: e["value"] == 1), F.lit(0))["slot"]
    return model.transform(o).select("o_orderkey", blocks).select(
        "o_orderkey", "b.column_name", "b.category", one.alias("category_index"))


TFIDF_SQL = r"""
toks AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]{2,}') AS t FROM documents),
grams AS (SELECT doc_id, unnest(t) AS term FROM toks
          UNION ALL
          SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term
          FROM toks WHERE len(t) > 1),
tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term),
nd AS (SELECT count(*) AS n FROM documents),
st AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term),
vocab AS (SELECT term, df, cf, ln((nd.n + 1.0) / (df + 1.0)) + 1 AS idf FROM st, nd
          WHERE df >= 2 AND df <= 0.95 * nd.n ORDER BY cf DESC, term LIMIT 4000)
"""


@query("tfidf_vocabulary", sql=f"""
WITH {TFIDF_SQL}
SELECT term, df, cf, round(idf, 6) AS idf FROM vocab
""")
def tfidf_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    v = FE.fit_tfidf(d, "doc_id", "text", 4000, 2, 0.95)
    return v.select("term", "df", "cf", r6("idf").alias("idf"))


@query("tfidf_documents", sql=f"""
WITH {TFIDF_SQL},
w AS (SELECT tf.doc_id, tf.term, tf.tf * v.idf AS w FROM tf JOIN vocab v ON tf.term = v.term)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w
""")
def tfidf_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return FE.tfidf(d, "doc_id", "text", 4000, 2, 0.95).select("doc_id", "term", r6("tfidf").alias("tfidf"))


@query("tfidf_pipeline_documents", sql=f"""
WITH {TFIDF_SQL},
w AS (SELECT tf.doc_id, tf.term, tf.tf * v.idf AS w FROM tf JOIN vocab v ON tf.term = v.term)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w
""")
def tfidf_pipeline_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature values that the model pipeline's text stage gives, in long form."""
    from tabrix.operators.stages import vector_entries

    terms = FE.with_terms(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "terms").drop("text")
    model = FE.tfidf_stages("text", "tfidf", 4000, 2, 0.95, terms_col="terms")[0].fit(terms)
    names = F.lit(model.stages[0].vocabulary)
    rows = model.transform(terms).select("doc_id", F.explode(vector_entries(F.col("tfidf"))).alias("e")).where("e.value != 0")
    return rows.select("doc_id", F.get(names, F.col("e.slot")).alias("term"), r6("e.value").alias("tfidf"))


SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _scaled_sql(exprs: dict, stats: str) -> str:
    cols = ", ".join(f"round({e}, 6) AS {c}" for c, e in exprs.items())
    return f"WITH s AS ({stats}) SELECT l_orderkey, l_linenumber, {cols} FROM lineitem, s"


def _nz(e: str) -> str:
    return f"CASE WHEN coalesce({e}, 0) = 0 THEN 1.0 ELSE {e} END"


@query("scale_lineitem_standard", sql=_scaled_sql(
    {c: f"{c} / {_nz('sd_' + c)}" for c in SCALE_COLS},
    "SELECT " + ", ".join(f"stddev_pop({c}) AS sd_{c}" for c in SCALE_COLS) + " FROM lineitem"))
def scale_lineitem_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, "standard")


@query("scale_lineitem_minmax", sql=_scaled_sql(
    {c: f"({c} - mn_{c}) / {_nz(f'(mx_{c} - mn_{c})')}" for c in SCALE_COLS},
    "SELECT " + ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in SCALE_COLS)
    + " FROM lineitem"))
def scale_lineitem_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, "minmax")


@query("scale_lineitem_robust", sql=_scaled_sql(
    {c: f"({c} - md_{c}) / {_nz(f'(q3_{c} - q1_{c})')}" for c in SCALE_COLS},
    "SELECT " + ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.5) AS md_{c}, "
                          f"quantile_cont({c}, 0.75) AS q3_{c}" for c in SCALE_COLS)
    + " FROM lineitem"))
def scale_lineitem_robust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, "robust")


@query("scale_pipeline_lineitem", sql=ORACLE_SQL["scale_lineitem_robust"])
def scale_pipeline_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The robust scale of the model pipeline's stage, as columns."""
    from pyspark.ml.functions import vector_to_array

    from tabrix.operators.model import scaler_stage

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *[F.col(c).cast("double").alias(c) for c in SCALE_COLS])
    rows = FE.assemble(SCALE_COLS, "v").transform(li)
    out = scaler_stage("robust", "v", "f").fit(rows).transform(rows).select("l_orderkey", "l_linenumber", vector_to_array("f").alias("f"))
    return out.select("l_orderkey", "l_linenumber", *[F.round(F.col("f")[i], 6).alias(c) for i, c in enumerate(SCALE_COLS)])


def _scaled(spark, sf_dir, kind):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *SCALE_COLS)
    out = FE.scale(li, SCALE_COLS, kind)
    return out.select("l_orderkey", "l_linenumber", *[r6(c).alias(c) for c in SCALE_COLS])
