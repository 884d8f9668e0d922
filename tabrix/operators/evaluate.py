"""Exact binary-classification metrics as aggregations.

* counts (confusion cells, log-loss sum) in ONE aggregate;
* ROC-AUC (Mann-Whitney, ties count half) and average precision (step sum,
  not trapezoid) from per-score counts and running sums over the score order
  (``prefix.running``: no single-partition window, no binning).

Outputs are tidy DataFrames: ``(metric, value)`` rows, ``(actual, predicted,
n)`` confusion cells and ``(row_name, precision, recall, f1_score, support)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabrix.functions.nulls import quoted
from tabrix.operators.prefix import running
from tabrix.session import materialize

# Fixed value: float64 machine epsilon used to clip probabilities in log loss.
EPS = 2.220446049250313e-16


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _counts(df: DataFrame, label: str, pred: str, score: str | None,
            by: Sequence[str] = ()) -> DataFrame:
    y = quoted(label).cast("int")
    p = quoted(pred).cast("int")
    aggs = [
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count(F.lit(1)).alias("n"),
    ]
    if score:
        s = F.least(F.greatest(quoted(score).cast("double"), F.lit(EPS)), F.lit(1 - EPS))
        aggs.append(F.avg(-(y * F.ln(s) + (1 - y) * F.ln(1 - s))).alias("log_loss"))
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Rows ``(actual, predicted, n)`` for the four cells (zeros included)."""
    c = _counts(df, label, pred, None)
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return c.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(k).alias("n"))
        for a, b, k in cells])).alias("c")).select("c.*")


def _score_counts(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives / negatives per (segment, distinct score), written once (the
    running sum reads it three times)."""
    y = quoted(label).cast("long")
    return materialize(df.where(quoted(score).isNotNull()).groupBy(
        *by, quoted(score).cast("double").alias("s")).agg(F.sum(y).alias("pos"),
                                                          F.sum(1 - y).alias("neg")))


def _grouped(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*by) if by else df.groupBy()


def rank_metrics(df: DataFrame, label: str = "label", score: str = "score",
                 by: Sequence[str] = ()) -> DataFrame:
    """``auc`` and ``pr_auc`` (per segment), NULL where undefined.

    auc: P(score_pos > score_neg) + 0.5 P(tie). pr_auc: sum over thresholds of
    (R_k - R_k-1) * P_k. The counts per score are written once; one ascending
    running sum serves both, since what lies above a score is the total less
    what lies below.
    """
    g = _score_counts(df, label, score, by)
    r = running(g, ["s"], [("pos_below", "sum", "pos"), ("neg_below", "sum", "neg")],
                partition_by=by, inclusive=False)
    totals = _grouped(g, by).agg(F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    if by:
        own = totals.select(*[quoted(c).alias(f"__by{i}") for i, c in enumerate(by)], "__p", "__n")
        same = [quoted(c).eqNullSafe(F.col(f"__by{i}")) for i, c in enumerate(by)]
        r = r.join(own, same)
    else:
        r = r.withColumns({c: totals.select(c).scalar() for c in ("__p", "__n")})
    below_p, below_n = (F.coalesce(c, F.lit(0)) for c in ("pos_below", "neg_below"))
    tp, fp = F.col("__p") - below_p, F.col("__n") - below_n
    return _grouped(r, by).agg(
        F.try_divide(F.sum(F.col("pos") * (below_n + 0.5 * F.col("neg"))).cast("double"),
                     (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"),
        F.try_divide(F.sum(F.col("pos") * tp / (tp + fp)), F.sum("pos").cast("double")).alias("pr_auc"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            by: Sequence[str] = ()) -> DataFrame:
    """``auc`` (per segment); NULL if there is one class."""
    return rank_metrics(df, label, score, by).select(*by, "auc")


def average_precision(df: DataFrame, label: str = "label", score: str = "score",
                      by: Sequence[str] = ()) -> DataFrame:
    """``pr_auc`` (per segment)."""
    return rank_metrics(df, label, score, by).select(*by, "pr_auc")


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction",
                   score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*by, metric, value)``: accuracy, balanced_accuracy, precision,
    recall, f1, auc, pr_auc, log_loss (positive class 1, undefined ratios -> 0)."""
    c = _counts(df, label, pred, score, by)
    tp, fp, tn, fn, n = (F.col(k) for k in ("tp", "fp", "tn", "fn", "n"))
    rec1 = F.try_divide(tp.cast("double"), (tp + fn).cast("double"))
    rec0 = F.try_divide(tn.cast("double"), (tn + fp).cast("double"))
    bal = F.when(rec1.isNull(), rec0).when(rec0.isNull(), rec1).otherwise((rec1 + rec0) / 2)
    rows = [
        ("accuracy", _div(tp + tn, n)),
        ("balanced_accuracy", bal),
        ("precision", _div(tp, tp + fp)),
        ("recall", _div(tp, tp + fn)),
        ("f1", _div(2 * tp, 2 * tp + fp + fn)),
        ("log_loss", F.col("log_loss")),
    ]
    base = c.select(*by, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in rows
    ])).alias("m")).select(*by, "m.*")
    ranked = rank_metrics(df, label, score, by).select(*by, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("auc", "pr_auc")])).alias("m"))
    return base.unionByName(ranked.select(*by, "m.*"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Rows per class '0', '1', then 'accuracy', 'macro avg', 'weighted avg'."""
    c = _counts(df, label, pred, None)
    tp, fp, tn, fn, n = (F.col(k) for k in ("tp", "fp", "tn", "fn", "n"))
    p1, r1, f1_1 = _div(tp, tp + fp), _div(tp, tp + fn), _div(2 * tp, 2 * tp + fp + fn)
    p0, r0, f1_0 = _div(tn, tn + fn), _div(tn, tn + fp), _div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _div(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("row_name"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                        s.cast("long").alias("support"))

    rows = [
        row("0", p0, r0, f1_0, s0),
        row("1", p1, r1, f1_1, s1),
        row("accuracy", F.lit(None), F.lit(None), acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row("weighted avg", _div(p0 * s0 + p1 * s1, n), _div(r0 * s0 + r1 * s1, n),
            _div(f1_0 * s0 + f1_1 * s1, n), n),
    ]
    return c.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
