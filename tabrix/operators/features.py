"""Feature operators: feature frame, manifest, one-hot, TF-IDF, scalers.

Relational ("long") forms are the distributed definition and the oracle
target; MLlib stages are provided for model pipelines.

* one-hot: vocabulary = sorted distinct values per column (positions from
  ``prefix.row_positions``, no per-column gathering); unseen / NULL -> no index
  (all-zero block).
* TF-IDF: a document's terms are counted inside its row (``document_terms``), and
  that table, written once, feeds vocabulary and weights. Tokens ``[\\p{L}\\p{N}_]{2,}`` of the lower-cased text (the pattern
  ``\\b\\w\\w+\\b`` with Unicode word characters), uni- and bigrams built after
  tokenising, ``min_df`` (count), ``max_df`` (share), the ``max_features``
  most frequent terms (ties: term ascending), smooth idf ``ln((1+n)/(1+df))+1``,
  raw counts x idf, L2-normalised per document. The vocabulary is a bounded
  top-k (broadcast); terms are shuffled once for the vocabulary (summed map-side)
  and the kept ones once by document.
* scalers: one aggregate (or one exact-quantile plan) -> literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrix.functions.nulls import is_numeric_type, quoted
from tabrix.functions.text import combine_columns
from tabrix.operators.parallel import spread
from tabrix.operators.prefix import row_positions, string_order_key
from tabrix.operators.stats import exact_quantiles
from tabrix.session import written

TFIDF_TOKEN = r"[\p{L}\p{N}_]{2,}"


class FeatureError(ValueError):
    pass


# -- frame and manifest -----------------------------------------------------

def feature_frame(df: DataFrame, target: str, text_sources: Sequence[str],
                  combined: str = "combined_text", include_original: bool = False) -> DataFrame:
    """Require the target, combine text sources, drop them, put the target last."""
    if target not in df.columns:
        raise FeatureError(f"the frame has no label column {target}")
    out = combine_columns(df, text_sources, combined, drop_sources=not include_original)
    return out.select(*[quoted(c) for c in out.columns if c != target], quoted(target))


def manifest(df: DataFrame, target: str, text_col: str = "combined_text") -> dict:
    """Numeric = numeric (or boolean) type; categorical = the rest but text.
    Schema only, no job."""
    feats = [c for c in df.columns if c != target]
    num = [c for c in feats if is_numeric_type(df.schema[c].dataType)]
    cat = [c for c in feats if c not in num and c != text_col]
    return {"target_column": target, "text_feature_column": text_col,
            "numeric_columns": num, "categorical_columns": cat}


# -- one-hot ----------------------------------------------------------------

def _long_values(df: DataFrame, cols: Sequence[str], key: str | None) -> DataFrame:
    keep = [quoted(key)] if key else []
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), quoted(c).cast("string").alias("category"))
        for c in cols])).alias("s")).select(*([key] if key else []), "s.column_name", "s.category")


def fit_one_hot(df: DataFrame, cols: Sequence[str], categories: DataFrame | None = None) -> DataFrame:
    """Vocabulary rows ``(column_name, category, category_index)`` (0-based,
    categories sorted ascending; NULL is not a category). ``categories`` may hold
    the distinct ``(column_name, category)`` rows if they are known already."""
    if categories is None:
        categories = _long_values(df, cols, None).where(F.col("category").isNotNull()).distinct()
    distinct = categories.select("column_name", "category")
    keyed = distinct.withColumn("__sk", string_order_key(F.col("category")))
    pos = row_positions(keyed, ["__sk", "category"], ["column_name"], out="__pos")
    return pos.select("column_name", "category", (F.col("__pos") - 1).cast("int").alias("category_index"))


def one_hot_long(df: DataFrame, key: str, cols: Sequence[str], vocab: DataFrame) -> DataFrame:
    """Rows ``(key, column_name, category, category_index)``; unseen / NULL
    categories keep a NULL index (an all-zero block in the vector form)."""
    long = _long_values(df, cols, key)
    return long.join(vocab, ["column_name", "category"], "left").select(
        key, "column_name", "category", "category_index")


def one_hot_stages(cols: Sequence[str], suffix: str = "_ohe"):
    """Pipeline stages: one vector block per column, all zeros for unseen and NULL values."""
    from tabrix.operators.stages import CategoryStage

    return [CategoryStage(inputCols=list(cols), outputCols=[f"{c}{suffix}" for c in cols])]


# -- TF-IDF -----------------------------------------------------------------

def tokens(text: Column) -> Column:
    """``[\\p{L}\\p{N}_]{2,}`` tokens of the lower-cased text."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TFIDF_TOKEN), 0)


def with_terms(df: DataFrame, text_col: str, out: str = "terms", ngram_max: int = 2) -> DataFrame:
    """Add ``out``: uni- (and bi-)grams of the tokens. Bigrams come from MLlib's
    ``NGram`` (compiled JVM code; an interpreted ``zip_with`` lambda is ~3x
    slower on whole documents)."""
    from pyspark.ml.feature import NGram

    tok = df.withColumn("__tok", tokens(quoted(text_col)))
    if ngram_max < 2:
        return tok.withColumnRenamed("__tok", out)
    grams = NGram(n=2, inputCol="__tok", outputCol="__bi").transform(tok)
    return grams.withColumn(out, F.concat("__tok", "__bi")).drop("__tok", "__bi")


def document_terms(df: DataFrame, key: str, text_col: str, ngram_max: int = 2) -> DataFrame:
    """``(key, terms)``: the distinct terms of each row with their counts, ``array<struct<term, tf>>``.

    All inside the row: terms are sorted, and the starts of equal runs give the
    counts, so nothing is shuffled. Both passes over ``terms`` are cheap once the
    table is written.
    """
    narrow = spread(df.select(quoted(key), quoted(text_col)))
    # lambdas bind the sorted terms and the starts, which are then computed once
    let = lambda value, body: F.transform(F.array(value), body)[0]
    starts = lambda s: F.filter(F.transform(s, lambda t, i: F.when((i == 0) | (F.get(s, i - 1) != t), i)),
                                lambda i: i.isNotNull())
    runs = lambda s, at: F.transform(at, lambda i, k: F.struct(
        F.get(s, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).cast("long").alias("tf")))
    terms = let(F.sort_array("__terms"), lambda s: let(starts(s), lambda at: runs(s, at)))
    return with_terms(narrow, text_col, "__terms", ngram_max).select(quoted(key), terms.alias("terms"))


def term_counts(terms: DataFrame, key: str) -> DataFrame:
    """``(key, term, tf)`` rows of a ``document_terms`` table."""
    # explode_outer and a filter: a plain explode infers size(terms) > 0, which would compute the terms twice
    each = terms.select(quoted(key), F.explode_outer("terms").alias("t")).where(F.col("t").isNotNull())
    return each.select(quoted(key), "t.term", "t.tf")


def fit_tfidf(df: DataFrame, key: str, text_col: str, max_features: int | None = 4000,
              min_df: int = 2, max_df: float = 0.95, ngram_max: int = 2, terms: DataFrame | None = None) -> DataFrame:
    """Vocabulary ``(term, df, cf, idf)``; at most ``max_features`` rows.

    ``terms``: the ``document_terms`` of ``df``, if they are written already.
    """
    terms = document_terms(df, key, text_col, ngram_max) if terms is None else terms
    n_docs = df.agg(F.count(F.lit(1)).alias("__n"))
    stats = term_counts(terms, key).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    from tabrix.operators.drift import one_row_join

    stats = one_row_join(stats, n_docs)
    max_count = F.lit(float(max_df)) * F.col("__n") if isinstance(max_df, float) else F.lit(max_df)
    kept = stats.where((F.col("df") >= F.lit(min_df)) & (F.col("df") <= max_count))
    if max_features:
        kept = kept.orderBy(F.desc("cf"), F.asc("term")).limit(int(max_features))
    idf = F.ln((F.col("__n") + 1) / (F.col("df") + 1)) + 1
    return kept.select("term", "df", "cf", idf.alias("idf"))


def tfidf_long(df: DataFrame, key: str, text_col: str, vocab: DataFrame,
               ngram_max: int = 2, terms: DataFrame | None = None) -> DataFrame:
    """``(key, term, tfidf)`` for vocabulary terms; L2 norm 1 per document."""
    terms = document_terms(df, key, text_col, ngram_max) if terms is None else terms
    v = F.broadcast(vocab.select("term", "idf"))  # bounded by max_features
    w = term_counts(terms, key).join(v, "term").select(quoted(key), "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(quoted(key))))
    return w.select(quoted(key), "term", (F.col("w") / norm).alias("tfidf"))


def tfidf(df: DataFrame, key: str, text_col: str, max_features: int | None = 4000, min_df: int = 2,
          max_df: float = 0.95, ngram_max: int = 2) -> DataFrame:
    """Vocabulary and weights from one reading of the texts: ``(key, term, tfidf)``."""
    terms = written(document_terms(df, key, text_col, ngram_max), "document-terms")
    vocab = written(fit_tfidf(terms, key, text_col, max_features, min_df, max_df, ngram_max, terms), "tfidf-vocabulary")
    return tfidf_long(df, key, text_col, vocab, ngram_max, terms)


def tfidf_stages(text_col: str, out: str = "tfidf", max_features: int = 4000, min_df: float = 2.0,
                 max_df: float = 0.95, terms_col: str | None = None):
    """Stages for model pipelines, with the weights of the relational form above.

    With ``terms_col`` (uni+bigrams already added by ``with_terms``, a stateless
    step done once before cross-validation) only the fitted stages remain:
    vocabulary and IDF, refitted inside every fold."""
    from pyspark.ml.feature import NGram, RegexTokenizer, SQLTransformer

    from tabrix.operators.stages import TfidfStage

    stages = []
    if terms_col is None:
        tok = RegexTokenizer(inputCol=text_col, outputCol=f"{out}__tok", gaps=False,
                             pattern=r"(?U)[\p{L}\p{N}_]{2,}", toLowercase=True)
        bi = NGram(n=2, inputCol=f"{out}__tok", outputCol=f"{out}__bi")
        merge = SQLTransformer(statement=f"SELECT *, concat(`{out}__tok`, `{out}__bi`) AS "
                                         f"`{out}__terms` FROM __THIS__")
        stages, terms_col = [tok, bi, merge], f"{out}__terms"
    return [*stages, TfidfStage(inputCol=terms_col, outputCol=out, maxFeatures=max_features, minDF=int(min_df), maxDF=float(max_df))]


# -- scalers ----------------------------------------------------------------

def fit_scaler(df: DataFrame, cols: Sequence[str], kind: str) -> dict:
    """Per column ``(center, scale)``; a zero scale becomes 1 (values kept /
    centred to 0). ``kind``: standard (population std, no centring), minmax,
    robust (median, IQR), none."""
    if kind == "none":
        return {c: (0.0, 1.0) for c in cols}
    if kind == "standard":
        row = df.agg(*[F.stddev_pop(quoted(c).cast("double")).alias(f"s{i}")
                       for i, c in enumerate(cols)]).first()
        return {c: (0.0, _nz(row[f"s{i}"])) for i, c in enumerate(cols)}
    if kind == "minmax":
        row = df.agg(*[F.min(quoted(c).cast("double")).alias(f"a{i}") for i, c in enumerate(cols)],
                     *[F.max(quoted(c).cast("double")).alias(f"b{i}") for i, c in enumerate(cols)]
                     ).first()
        return {c: (row[f"a{i}"] or 0.0, _nz(None if row[f"a{i}"] is None else
                                              row[f"b{i}"] - row[f"a{i}"]))
                for i, c in enumerate(cols)}
    if kind == "robust":
        q = {(r["column"], r["prob"]): r["value"]
             for r in exact_quantiles(df, cols, [0.25, 0.5, 0.75]).collect()}
        out = {}
        for c in cols:
            lo, med, hi = q.get((c, 0.25)), q.get((c, 0.5)), q.get((c, 0.75))
            out[c] = (med or 0.0, _nz(None if lo is None else hi - lo))
        return out
    raise FeatureError(f"no scaling is called {kind!r}")


def _nz(v):
    return 1.0 if v is None or v == 0 else float(v)


def apply_scaler(df: DataFrame, stats: dict) -> DataFrame:
    return df.select(*[
        ((quoted(c).cast("double") - F.lit(stats[c][0])) / F.lit(stats[c][1])).alias(c)
        if c in stats else quoted(c) for c in df.columns])


def scale(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    return apply_scaler(df, fit_scaler(df, cols, kind))


def assemble(cols: Sequence[str], out: str = "features"):
    """MLlib ``VectorAssembler`` over the feature blocks; no block -> error."""
    from pyspark.ml.feature import VectorAssembler

    if not cols:
        raise FeatureError("nothing to assemble: no numeric, category or text features")
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")
