"""Data, concept and model drift, and the retrain signal.

* numeric features (numeric on both sides): relative mean shift, from one
  ``avg`` aggregate per frame over all numeric columns;
* other features: PSI over the union of observed values (value as text, NULL is
  the value ``'nan'`` as in the reference), from one unpivot + count per frame;
* ``by=[...]`` (e.g. a time window of the current frame) gives one result per
  segment without a cross join: PSI is decomposed into a sum over current values
  (left join to the reference) plus a per-feature constant for reference-only
  values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.functions.nulls import is_numeric_type, present, quoted
from tabrix.operators.prefix import running

PSI_EPS = 1e-6
MEAN_EPS = 1e-6


def split_features(ref: DataFrame, cur: DataFrame, target: str | None,
                   exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) common features, target and ``exclude`` removed."""
    skip = set(exclude) | ({target} if target else set())
    common = [c for c in ref.columns if c in cur.columns and c not in skip]
    num = [c for c in common if is_numeric_type(ref.schema[c].dataType)
           and is_numeric_type(cur.schema[c].dataType)]
    return num, [c for c in common if c not in num]


def _means(df: DataFrame, cols: Sequence[str], by: Sequence[str], prefix: str) -> DataFrame:
    agg = df.groupBy(*by).agg(*[F.avg(F.when(~F.isnan(quoted(c).cast("double")),
                                             quoted(c).cast("double"))).alias(f"__m{i}")
                                for i, c in enumerate(cols)])
    return agg.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"__m{i}").alias(prefix))
        for i, c in enumerate(cols)])).alias("s")).select(*by, "s.*")


def mean_shift(ref: DataFrame, cur: DataFrame, cols: Sequence[str], threshold: float = 0.20,
               by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*by, feature, ref_mean, cur_mean, score, threshold, drifted)``."""
    r = _means(ref, cols, (), "ref_mean")
    c = _means(cur, cols, by, "cur_mean")
    j = c.join(F.broadcast(r), "feature")  # r: one row per feature
    denom = F.when(F.abs("ref_mean") > MEAN_EPS, F.abs("ref_mean")).otherwise(F.lit(1.0))
    score = F.abs(F.col("cur_mean") - F.col("ref_mean")) / denom
    return j.select(*by, "feature", "ref_mean", "cur_mean", score.alias("score"),
                    F.lit(float(threshold)).alias("threshold"),
                    F.coalesce(score > F.lit(float(threshold)), F.lit(False)).alias("drifted"))


def value_text(df: DataFrame, col: str):
    """Value as text, missing -> 'nan' (pandas ``astype(str)`` of a missing value)."""
    c = quoted(col)
    dt = df.schema[col].dataType
    if is_numeric_type(dt) and dt.typeName() in ("double", "float"):
        c = F.when(~F.isnan(c), c)
    return F.coalesce(c.cast("string"), F.lit("nan"))


def distribution(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*by, feature, value, share)``: share of rows per value (one shuffle
    for all columns; map-side combine absorbs hot values)."""
    long = df.select(*[quoted(b) for b in by], F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), value_text(df, c).alias("value")) for c in cols
    ])).alias("s")).select(*by, "s.feature", "s.value")
    counts = long.groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__total"))
    joined = counts.join(totals, list(by)) if by else one_row_join(counts, totals)
    return joined.select(*by, "feature", "value", (F.col("n") / F.col("__total")).alias("share"))


def one_row_join(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row as scalar
    subqueries (computed once, merged by the optimiser; no join at all)."""
    return df.select("*", *[one_row.select(F.col(f"`{c}`")).scalar().alias(c)
                            for c in one_row.columns])


def _term(c, r):
    return (c - r) * F.ln(c / r)


def psi(ref: DataFrame, cur: DataFrame, cols: Sequence[str], threshold: float = 0.20,
        by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*by, feature, score, threshold, drifted)``; PSI with shares clipped
    at 1e-6 and absent values counted as 1e-6."""
    eps = F.lit(PSI_EPS)
    rd = distribution(ref, cols).select("feature", "value", F.col("share").alias("r"))
    cd = distribution(cur, cols, by).select(*by, "feature", "value", F.col("share").alias("c"))
    if not by:
        j = cd.join(rd, ["feature", "value"], "full_outer")
        r = F.greatest(F.coalesce("r", eps), eps)
        c = F.greatest(F.coalesce("c", eps), eps)
        scores = j.groupBy("feature").agg(F.sum(_term(c, r)).alias("score"))
    else:
        ref_only = rd.groupBy("feature").agg(
            F.sum(_term(eps, F.greatest("r", eps))).alias("__ref_all"))
        j = cd.join(rd, ["feature", "value"], "left")
        r = F.greatest(F.coalesce("r", eps), eps)
        c = F.greatest("c", eps)
        part = j.groupBy(*by, "feature").agg(
            F.sum(_term(c, r)).alias("__cur"),
            F.sum(F.when(F.col("r").isNotNull(), _term(eps, r)).otherwise(0.0)).alias("__shared"))
        scores = part.join(F.broadcast(ref_only), "feature", "left").select(
            *by, "feature",
            (F.col("__cur") + F.coalesce("__ref_all", F.lit(0.0)) - F.col("__shared")).alias("score"))
    return scores.select(*by, "feature", "score", F.lit(float(threshold)).alias("threshold"),
                         F.coalesce(F.col("score") > F.lit(float(threshold)),
                                    F.lit(False)).alias("drifted"))


def feature_drift(ref: DataFrame, cur: DataFrame, target: str | None, mean_threshold: float = 0.20,
                  psi_threshold: float = 0.20, exclude: Sequence[str] = (),
                  by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(*by, feature, drift_type, score, threshold, drifted)`` for every
    common feature (``drift.features`` + ``drift.mean_shift`` + ``drift.psi``)."""
    num, cat = split_features(ref, cur, target, list(exclude) + list(by))
    parts = []
    if num:
        parts.append(mean_shift(ref, cur, num, mean_threshold, by).select(
            *by, "feature", F.lit("numeric_mean_shift").alias("drift_type"), "score", "threshold",
            "drifted"))
    if cat:
        parts.append(psi(ref, cur, cat, psi_threshold, by).select(
            *by, "feature", F.lit("categorical_psi").alias("drift_type"), "score", "threshold",
            "drifted"))
    if not parts:
        return ref.sparkSession.createDataFrame(
            [], "feature string, drift_type string, score double, threshold double, drifted boolean")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def data_drift(features: DataFrame, ratio_threshold: float = 0.30,
               by: Sequence[str] = ()) -> DataFrame:
    """``drift.data`` summary: drifted / checked > threshold (0 features -> 0)."""
    g = features.groupBy(*by) if by else features.groupBy()
    agg = g.agg(F.count(F.lit(1)).alias("n_features"),
                F.count_if("drifted").alias("n_drifted"))
    ratio = F.coalesce(F.try_divide(F.col("n_drifted").cast("double"),
                                    F.col("n_features").cast("double")), F.lit(0.0))
    return agg.select(*by, "n_features", "n_drifted", ratio.alias("drifted_feature_ratio"),
                      F.lit(float(ratio_threshold)).alias("threshold"),
                      (ratio > F.lit(float(ratio_threshold))).alias("status"))


def concept_drift(ref: DataFrame, cur: DataFrame, target: str, threshold: float = 0.05,
                  by: Sequence[str] = ()) -> DataFrame:
    """``|mean(target_cur) - mean(target_ref)| > threshold``; a missing target
    column gives status false with a message."""
    spark = ref.sparkSession
    if target not in ref.columns or target not in cur.columns:
        return spark.createDataFrame(
            [(None, None, None, float(threshold), False,
              f"no column {target}: label rates cannot be compared")],
            "reference_target_rate double, current_target_rate double, delta double, "
            "threshold double, status boolean, message string")
    t = lambda df: F.avg(quoted(target).cast("string").try_cast("double"))
    r = ref.agg(t(ref).alias("reference_target_rate"))
    c = cur.groupBy(*by).agg(t(cur).alias("current_target_rate"))
    j = one_row_join(c, r)
    delta = F.abs(F.col("current_target_rate") - F.col("reference_target_rate"))
    return j.select(*by, "reference_target_rate", "current_target_rate", delta.alias("delta"),
                    F.lit(float(threshold)).alias("threshold"),
                    F.coalesce(delta > F.lit(float(threshold)), F.lit(False)).alias("status"),
                    F.lit(None).cast("string").alias("message"))


def model_drift(current: DataFrame, baseline: DataFrame, metric_name: str = "auc",
                threshold: float = 0.05) -> DataFrame:
    """``current(metric, value)`` vs ``baseline(metric, value)`` (0 or 1 row for
    the metric). No baseline -> status false, drop 0. Metric missing -> error on
    evaluation."""
    # a global aggregate: a missing metric is a row with NULL, not an empty frame
    cur = current.agg(F.max(F.when(F.col("metric") == metric_name, F.col("value"))).alias("current_metric"))
    base = baseline.where(F.col("metric") == metric_name).select(F.col("value").alias("baseline_metric"))
    cur = present(cur, "current_metric", f"the evaluation holds no {metric_name} to compare")
    j = cur.withColumn("baseline_metric", base.limit(1).scalar())
    b = F.col("baseline_metric")
    denom = F.when(F.abs(b) > MEAN_EPS, F.abs(b)).otherwise(F.lit(1.0))
    drop = F.when(b.isNull(), F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), (b - F.col("current_metric")) / denom))
    return j.select(F.lit(metric_name).alias("metric_name"), "current_metric", "baseline_metric",
                    drop.alias("relative_drop"), F.lit(float(threshold)).alias("threshold"),
                    (drop > F.lit(float(threshold))).alias("status"))


def champion_history(ledger: DataFrame, keys: Sequence[str] = ("model_name", "env"), ts: str = "ts") -> DataFrame:
    """``(keys, ts, seq, champion, champion_score)``: who is champion after each run of a ``promote.ledger``."""
    held = F.when(F.col("decision") == "promote", F.col("score")).otherwise(F.col("best_score_before"))
    return ledger.where(F.col("champion_after").isNotNull()).select(
        *keys, ts, F.col("version").alias("seq"), F.col("champion_after").alias("champion"), held.cast("double").alias("champion_score"))


def model_drift_asof(evaluations: DataFrame, history: DataFrame, keys: Sequence[str] = ("model_name", "env"), ts: str = "ts",
                     value: str = "value", threshold: float = 0.05, higher_is_better: bool = True) -> DataFrame:
    """``evaluations`` with ``baseline_version``, ``baseline_metric``, ``relative_drop`` and ``status``.

    The baseline of an evaluation is the champion that was valid at its time (a run
    of the same moment counts). No range join: evaluations and champions are put in
    one order of time per key, and each evaluation carries the last champion before
    it (``prefix.running``: a hot key is spread over range bins). No champion yet ->
    drop 0, status false; a NULL value has a NULL drop and status false.
    """
    cols = evaluations.columns
    seq = history.schema["seq"].dataType
    champion = F.struct("champion", "champion_score")
    none = F.lit(None).cast(history.select(champion.alias("c")).schema["c"].dataType)
    row = F.struct(*[quoted(c) for c in cols])
    order = F.lit(None).cast(seq).alias("__seq")
    rows = history.select(*keys, quoted(ts).alias("__ts"), F.lit(0).alias("__kind"), F.col("seq").alias("__seq"), champion.alias("__champion"),
                          F.lit(None).cast(evaluations.select(row.alias("r")).schema["r"].dataType).alias("__row"))
    rows = rows.unionByName(evaluations.select(*keys, quoted(ts).alias("__ts"), F.lit(1).alias("__kind"), order, none.alias("__champion"), row.alias("__row")))
    # champions come before evaluations of the same moment
    found = running(rows, ["__ts", "__kind", "__seq"], [("__base", "last", "__champion")], partition_by=list(keys)).where("__kind = 1")
    now, base = F.col(f"__row.`{value}`"), F.col("__base.champion_score")
    denom = F.when(F.abs(base) > MEAN_EPS, F.abs(base)).otherwise(F.lit(1.0))
    worse = (base - now) if higher_is_better else (now - base)
    drop = F.when(base.isNull(), F.lit(0.0)).when(now.isNotNull(), F.greatest(F.lit(0.0), worse / denom))
    return found.select(*[F.col(f"__row.`{c}`").alias(c) for c in cols], F.col("__base.champion").alias("baseline_version"),
                        base.alias("baseline_metric"), drop.alias("relative_drop"), F.lit(float(threshold)).alias("threshold"),
                        F.coalesce(drop > F.lit(float(threshold)), F.lit(False)).alias("status"))


def retrain_signal(data: DataFrame, concept: DataFrame, model: DataFrame) -> DataFrame:
    """One row: the three statuses and their OR (each input is a one-row frame).

    The three rows are unioned and folded by one global aggregate: no join and
    no nested scalar subquery."""
    parts = [data.select(F.lit("data").alias("__k"), F.col("status").alias("__s")),
             concept.select(F.lit("concept").alias("__k"), F.col("status").alias("__s")),
             model.select(F.lit("model").alias("__k"), F.col("status").alias("__s"))]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    pick = lambda k: F.coalesce(F.bool_or(F.when(F.col("__k") == k, F.col("__s"))),
                                F.lit(False))
    return u.agg(pick("data").alias("data_drift"), pick("concept").alias("concept_drift"),
                 pick("model").alias("model_drift"),
                 F.coalesce(F.bool_or("__s"), F.lit(False)).alias("should_retrain"))
