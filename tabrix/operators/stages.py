"""Pipeline stages that encode, weigh and scale exactly as the relational operators do.

* ``CategoryStage`` fits the vocabulary of ``fit_one_hot`` as a table in the shared
  folder; only its size per column reaches the driver. Rows find their index in two
  steps: the ``NEAR`` most frequent categories of a column are a broadcast join, and
  only rows with a value that is not among them are shuffled to the rest of the
  vocabulary. So hot values are not shuffled, and a column may have any number of
  categories. Unseen and NULL values get an all-zero block.
* ``TfidfStage`` fits the vocabulary of ``fit_tfidf`` (corpus count descending,
  then term) and gives smoothed idf and rows of L2 norm 1.
* ``ScaleStage`` divides by the population deviation (``standard``), maps to the
  value range (``minmax``) or centres on the median and divides by the interquartile
  range (``robust``, exact order statistics of the entries that are not zero, with
  the zeros counted in); a constant feature keeps its scale. Features whose centres
  are all zero stay sparse.

All are fitted inside each cross-validation fold, and can be saved unfitted or
fitted. At most ``max_features`` terms and a few numbers per feature reach the driver.
"""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, OneHotEncoder
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrix.functions.nulls import quoted
from tabrix.operators.stats import order_statistics, sketch
from tabrix.session import scratch_path, written

#: Categories of a column that are broadcast.
NEAR = 1000


class _Built:
    """Sets the parameters that a constructor was given."""

    def _build(self):
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})


# -- categories -------------------------------------------------------------

class _VocabularyWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:  # noqa: N802 - named by the library
        super().saveImpl(path)
        self.instance.table(self.sparkSession).write.parquet(f"{path}/vocabulary")


class _VocabularyReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        return model._set(vocabulary=f"{path}/vocabulary")


class CategoryIndexModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable, _Built):
    """Category to index; unseen and NULL values get the index after the last."""

    vocabulary = Param(Params._dummy(), "vocabulary", "folder of the vocabulary table", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "categories per column", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, vocabulary=None, sizes=None):
        super().__init__()
        self._build()

    def table(self, spark) -> DataFrame:
        return spark.read.parquet(self.getOrDefault("vocabulary"))

    def write(self):
        return _VocabularyWriter(self)

    @classmethod
    def read(cls):
        return _VocabularyReader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        table, names = self.table(df.sparkSession), df.columns
        columns, outs, sizes = self.getInputCols(), self.getOutputCols(), self.getOrDefault("sizes")

        def indexed(d: DataFrame, i: int, near: bool) -> DataFrame:
            """``d`` with the index of column ``i`` from the near or the far part of its vocabulary."""
            part = table.where((F.col("column_name") == columns[i]) & (F.col("place") <= NEAR if near else F.col("place") > NEAR))
            part = part.select(F.col("category").alias("__category"), F.col("category_index").alias("__index"))
            part = F.broadcast(part) if near else part  # near: at most NEAR rows
            d = d.join(part, quoted(columns[i]).cast("string") == F.col("__category"), "left").drop("__category")
            at = F.col("__index") if near else F.coalesce(f"__i{i}", "__index")
            return d.withColumn(f"__i{i}", at).drop("__index")

        out = df
        for i in range(len(columns)):
            out = indexed(out, i, near=True)
        far = [i for i, n in enumerate(sizes) if n > NEAR]
        if far:
            open_ = F.lit(False)
            for i in far:
                open_ = open_ | (F.col(f"__i{i}").isNull() & quoted(columns[i]).isNotNull())
            rest = out.where(open_)
            for i in far:
                rest = indexed(rest, i, near=False)
            out = out.where(~open_).unionByName(rest)
        return out.select(*map(quoted, names), *[
            F.coalesce(F.col(f"__i{i}"), F.lit(n)).cast("double").alias(o) for i, (o, n) in enumerate(zip(outs, sizes, strict=True))])


class CategoryStage(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable, _Built):
    """Sorted categories per column to one-hot vectors; ``outputCols`` are the vectors."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._build()

    def _counts(self, df: DataFrame, fold_col: str | None = None, num_folds: int = 0) -> DataFrame:
        """Rows of each category: ``n`` of all, ``n_0``, ... of those outside a fold."""
        from tabrix.operators.features import _long_values

        if fold_col:
            df = df.withColumn("__fold", quoted(fold_col))
        values = _long_values(df, self.getInputCols(), "__fold" if fold_col else None).where("category IS NOT NULL")
        return written(values.groupBy("column_name", "category").agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("__fold") != k).alias(f"n_{k}") for k in range(num_folds)]), "category-counts")

    def _fit(self, df: DataFrame) -> PipelineModel:
        return self._model(self._counts(df))

    def fold_models(self, df: DataFrame, fold_col: str, num_folds: int) -> list[PipelineModel]:
        """What fitting on the rows outside fold 0, 1, ... gives, and last on all rows, from one pass over the rows."""
        counts = self._counts(df, fold_col, num_folds)
        outside = [counts.select("column_name", "category", F.col(f"n_{k}").alias("n")).where("n > 0") for k in range(num_folds)]
        return [self._model(c) for c in [*outside, counts.select("column_name", "category", "n")]]

    def _model(self, counts: DataFrame) -> PipelineModel:
        from tabrix.operators.features import fit_one_hot

        columns, outs = self.getInputCols(), self.getOutputCols()
        vocab = fit_one_hot(counts, columns, counts)
        # which categories are near: a top-k per column, cut before the shuffle
        order = Window.partitionBy("column_name").orderBy(F.desc("n"), "category")
        top = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= NEAR)
        placed = vocab.join(F.broadcast(top.select("column_name", "category", "place")), ["column_name", "category"], "left")
        table = placed.withColumn("place", F.coalesce("place", F.lit(NEAR + 1)))
        folder = scratch_path(counts.sparkSession, "categories")
        table.write.parquet(folder)
        sizes = {r["column_name"]: r["n"] for r in counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}
        # a column without any category has one that never occurs
        sizes = [max(sizes.get(c, 0), 1) for c in columns]
        index = [f"{o}__idx" for o in outs]
        last = counts.sparkSession.range(0, 1, 1, 1).select(*[F.lit(float(n - 1)).alias(c) for c, n in zip(index, sizes, strict=True)])
        blocks = OneHotEncoder(inputCols=index, outputCols=outs, dropLast=True, handleInvalid="keep").fit(last)
        return PipelineModel([CategoryIndexModel(inputCols=columns, outputCols=index, vocabulary=folder, sizes=sizes), blocks])


# -- terms ------------------------------------------------------------------

class TfidfStage(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable, _Built):
    """Terms (array of strings) to L2-normed TF-IDF vectors."""

    maxFeatures = Param(Params._dummy(), "maxFeatures", "most frequent terms that are kept", TypeConverters.toInt)
    minDF = Param(Params._dummy(), "minDF", "least number of documents of a term", TypeConverters.toInt)
    maxDF = Param(Params._dummy(), "maxDF", "largest share of documents of a term", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, maxFeatures=4000, minDF=2, maxDF=0.95):
        super().__init__()
        self._build()

    def occurrences(self, df: DataFrame, *more: Column) -> DataFrame:
        """A row per term of each document, with whether it is the document's first of that term, and ``more``."""
        terms = F.coalesce(quoted(self.getInputCol()), F.array().cast("array<string>"))
        # one pass: in a sorted document, a term's first occurrence counts the document
        runs = F.transform(F.array(F.sort_array(F.filter(terms, lambda t: t.isNotNull()))), lambda s: F.transform(
            s, lambda t, i: F.struct(t.alias("term"), F.when((i == 0) | (F.get(s, i - 1) != t), 1).otherwise(0).alias("first"))))[0]
        return df.select(F.explode(runs).alias("t"), *more).select("t.term", "t.first", "*").drop("t")

    def _most_frequent(self, stats: DataFrame, n: int) -> list:
        kept = stats.where((F.col("df") >= self.getOrDefault("minDF")) & (F.col("df") <= self.getOrDefault("maxDF") * n))
        return kept.orderBy(F.desc("cf"), "term").limit(self.getOrDefault("maxFeatures")).collect()

    def vocabulary(self, df: DataFrame) -> tuple[list, int]:
        n = df.count()
        stats = self.occurrences(df).groupBy("term").agg(F.count(F.lit(1)).alias("cf"), F.sum("first").alias("df"))
        return self._most_frequent(stats, n), n

    def fold_models(self, df: DataFrame, fold_col: str, num_folds: int) -> list[PipelineModel]:
        """What fitting on the rows outside fold 0, 1, ... gives, and last on all rows, from one pass over the terms.

        A term's counts outside a fold are those in any fold less those in this one;
        rows without a fold count for all rows alone. Terms in fewer than ``minDF`` of
        all documents are in none of the vocabularies.
        """
        fold, folds = F.col("__fold"), range(num_folds)
        df = df.withColumn("__fold", quoted(fold_col))
        sizes = df.agg(F.count(F.lit(1)), F.count(fold), *[F.count_if(fold == k) for k in folds]).first()
        first = F.col("first")
        stats = self.occurrences(df, fold).groupBy("term").agg(
            F.count(F.lit(1)).alias("cf"), F.sum(first).alias("df"),
            F.count(fold).alias("cf_set"), F.sum(F.when(fold.isNotNull(), first).otherwise(0)).alias("df_set"),
            *[F.count_if(fold == k).alias(f"cf_{k}") for k in folds],
            *[F.sum(F.when(fold == k, first).otherwise(0)).alias(f"df_{k}") for k in folds])
        stats = written(stats.where(F.col("df") >= self.getOrDefault("minDF")), "fold-terms")
        outside = [(stats.select("term", (F.col("cf_set") - F.col(f"cf_{k}")).alias("cf"), (F.col("df_set") - F.col(f"df_{k}")).alias("df")),
                    sizes[1] - sizes[2 + k]) for k in folds]
        return [self._model(self._most_frequent(s, n), n) for s, n in [*outside, (stats.select("term", "cf", "df"), sizes[0])]]

    def _fit(self, df: DataFrame) -> PipelineModel:
        return self._model(*self.vocabulary(df))

    def _model(self, rows: list, n: int) -> PipelineModel:
        from tabrix.operators.features import FeatureError

        if not rows:
            raise FeatureError(f"no term of {self.getInputCol()} is frequent enough for a vocabulary")
        idf = Vectors.dense([math.log((n + 1) / (r["df"] + 1)) + 1 for r in rows])
        out = self.getOutputCol()
        counts, weights = f"{out}__tf", f"{out}__w"
        return PipelineModel([
            CountVectorizerModel.from_vocabulary([r["term"] for r in rows], self.getInputCol(), counts),
            ElementwiseProduct(scalingVec=idf, inputCol=counts, outputCol=weights),
            Normalizer(p=2.0, inputCol=weights, outputCol=out),
        ])


# -- scales -----------------------------------------------------------------

class CentreScale(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable, _Built):
    """(x - centre) / scale per vector element."""

    centre = Param(Params._dummy(), "centre", "subtracted per element", TypeConverters.toListFloat)
    scale = Param(Params._dummy(), "scale", "divides per element", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, centre=None, scale=None):
        super().__init__()
        self._build()

    def _transform(self, df: DataFrame) -> DataFrame:
        x = vector_to_array(quoted(self.getInputCol()))
        for values, op in ((self.getOrDefault("centre"), lambda a, b: a - b), (self.getOrDefault("scale"), lambda a, b: a / b)):
            x = F.zip_with(x, F.lit(list(values)), op)
        return df.withColumn(self.getOutputCol(), array_to_vector(x))


def vector_entries(vector: Column) -> Column:
    """``(slot, value)`` of the entries that a vector holds, without making a sparse one dense."""
    v = F.unwrap_udt(vector)
    slots = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.greatest(F.size(v["values"]) - 1, F.lit(0))))
    return F.zip_with(slots, v["values"], lambda i, x: F.struct(i.alias("slot"), x.alias("value")))


class ScaleStage(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable, _Built):
    """``kind``: standard (population deviation, not centred), minmax, or robust (median, interquartile range)."""

    kind = Param(Params._dummy(), "kind", "standard, minmax or robust", TypeConverters.toString)

    @keyword_only
    def __init__(self, kind=None, inputCol=None, outputCol=None):
        super().__init__()
        self._build()

    def _stage(self, centre: list[float], scale: list[float]):
        if any(centre):
            return CentreScale(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), centre=centre, scale=scale)
        factor = Vectors.dense([1.0 / s for s in scale])
        return ElementwiseProduct(scalingVec=factor, inputCol=self.getInputCol(), outputCol=self.getOutputCol())

    def _fit(self, df: DataFrame):
        if self.getOrDefault("kind") == "robust":
            return self._robust(df)
        s = df.select(Summarizer.metrics("count", "std", "min", "max").summary(quoted(self.getInputCol())).alias("s")).first()["s"]
        if self.getOrDefault("kind") == "standard":
            to_population = math.sqrt((s["count"] - 1) / s["count"]) if s["count"] else 1.0
            scale = [v * to_population if v * to_population > 0 else 1.0 for v in s["std"]]
            return self._stage([0.0] * len(scale), scale)
        low = [float(v) for v in s["min"]]
        return self._stage(low, [float(b - a) or 1.0 for a, b in zip(s["min"], s["max"], strict=True)])

    def _robust(self, df: DataFrame):
        v = F.unwrap_udt(quoted(self.getInputCol()))
        width = F.when(v["type"] == 0, v["size"]).otherwise(F.size(v["values"]))
        n, d = df.agg(F.count(F.lit(1)), F.coalesce(F.max(width), F.lit(0))).first()
        held = df.select(F.explode(vector_entries(quoted(self.getInputCol()))).alias("e"))
        long = held.select(F.col("e.slot").alias("column"), F.col("e.value").alias("value")).where((F.col("value") != 0) & ~F.isnan("value"))
        sketched = written(sketch(long).join(long.groupBy("column").agg(F.count_if(F.col("value") < 0).alias("below")), "column"), "slot-sketch")
        # place j among all n values of a slot: below zero, zero, or that much further on among the others
        ranks = sorted({r for p in (0.25, 0.5, 0.75) for r in (math.floor((n - 1) * p), math.ceil((n - 1) * p))}) if n else []
        zeros = F.lit(n) - F.col("n")
        places = sketched.select("column", F.explode(F.array(*[F.lit(r).cast("long") for r in ranks] or [F.lit(0).cast("long")])).alias("rank"),
                                 "below", zeros.alias("zeros"))
        is_zero = (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("zeros"))
        j = F.when(F.col("rank") < F.col("below"), F.col("rank")).otherwise(F.col("rank") - F.col("zeros"))
        asked = written(places.where(~is_zero).select("column", "rank", j.alias("j")), "slot-ranks")
        stats = order_statistics(long, asked.select("column", "j").distinct(), sketched.select("column", "n", "grid"))
        value = {(r["column"], r["rank"]): r["value"] for r in asked.join(stats, ["column", "j"]).collect()}  # numbers per feature

        def quantile(slot: int, p: float) -> float:
            h = (n - 1) * p
            lo, hi = math.floor(h), math.ceil(h)
            a, b = value.get((slot, lo), 0.0), value.get((slot, hi), 0.0)
            return a if lo == hi else (hi - h) * a + (h - lo) * b

        if not n:
            return self._stage([0.0] * d, [1.0] * d)
        return self._stage([quantile(i, 0.5) for i in range(d)], [(quantile(i, 0.75) - quantile(i, 0.25)) or 1.0 for i in range(d)])
