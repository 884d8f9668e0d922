"""Cleaning operators: names, strings, categories, tokens, dedup, casts,
imputation and label encoding.

Fit/apply pairs (``fit_*`` returns a small plain-Python object computed by one
aggregate job; ``apply_*`` is a pure projection) let train statistics be applied
to test. ``per_frame=True`` reproduces the reference, which fits on each frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.functions.nulls import (DEFAULT_NULL_TOKENS, is_numeric_type, quoted, safe_double,
                                    strip_ws)
from tabrix.operators.keyed import join_unique
from tabrix.operators.prefix import row_positions, string_order_key
from tabrix.operators.stats import column_modes, exact_quantiles
from tabrix.session import written

# The reference's column renames and categorical value maps
# (plain strings: the YAML 1.1 yes/no-as-boolean quirk is not reproduced).
DEFAULT_RENAMES = {
    "capital-gains": "capital_gains",
    "capital-loss": "capital_loss",
    "policy_deductable": "policy_deductible",
}
DEFAULT_VALUE_MAPS = {
    "insured_sex": {"male": "MALE", "female": "FEMALE", "m": "MALE", "f": "FEMALE"},
    "property_damage": {"yes": "YES", "no": "NO", "y": "YES", "n": "NO"},
    "police_report_available": {"yes": "YES", "no": "NO", "y": "YES", "n": "NO"},
    "fraud_reported": {"yes": "Y", "no": "N", "y": "Y", "n": "N", "1": "Y", "0": "N"},
}
UNKNOWN = "UNKNOWN"
MAX_LABELS = 100_000


class UnknownLabelError(ValueError):
    pass


def normalize_name(name: str) -> str:
    return name.strip().lower().replace("-", "_").replace(" ", "_")


def rename_columns(df: DataFrame, mapping: Mapping[str, str] = DEFAULT_RENAMES) -> DataFrame:
    """Rename by map (unknown names ignored), then normalise every name."""
    new = [normalize_name(mapping.get(c, c)) for c in df.columns]
    if len(set(new)) != len(new):
        dup = sorted({n for n in new if new.count(n) > 1})
        raise ValueError(f"column names collide after renaming: {dup}")
    return df.select(*[quoted(c) if c == n else quoted(c).alias(n) for c, n in zip(df.columns, new)])


def _string_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip leading/trailing whitespace of every string column (one select)."""
    s = set(_string_cols(df))
    return df.select(*[strip_ws(quoted(c)).alias(c) if c in s else quoted(c) for c in df.columns])


def map_categories(df: DataFrame, value_maps: Mapping[str, Mapping[str, str]] = DEFAULT_VALUE_MAPS,
                   legacy_nan_text: bool = False) -> DataFrame:
    """Per-column dictionary on ``lower(x)``; unmapped values -> ``upper(x)``.

    NULL stays NULL (``legacy_nan_text=True``: NULL -> 'NAN', as the reference's
    ``astype(str)`` does).
    """
    exprs = []
    for c in df.columns:
        if c in value_maps:
            flat = []
            for k, v in sorted(value_maps[c].items()):
                flat.extend([F.lit(str(k)), F.lit(str(v))])
            m = F.create_map(*flat)
            x = quoted(c).cast("string")
            if legacy_nan_text:
                x = F.coalesce(x, F.lit("nan"))
            exprs.append(F.coalesce(F.try_element_at(m, F.lower(x)), F.upper(x)).alias(c))
        else:
            exprs.append(quoted(c))
    return df.select(*exprs)


def null_tokens(df: DataFrame, tokens: Sequence[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """String values that are, trimmed and lowered, placeholder tokens -> NULL."""
    toks = sorted({str(t).strip().lower() for t in tokens})
    s = set(_string_cols(df))
    return df.select(*[
        F.when(~F.coalesce(F.lower(strip_ws(quoted(c))).isin(toks), F.lit(False)), quoted(c)).alias(c)
        if c in s else quoted(c) for c in df.columns])


def drop_duplicates(df: DataFrame, key: str | None = None) -> DataFrame:
    """Full-row dedup, NULLs equal (hash aggregate with map-side combine).

    With a unique ``key``, rows that agree in all other columns are equal and the
    one with the smallest key stays.
    """
    if key is None:
        return df.dropDuplicates()
    rest = [quoted(c) for c in df.columns if c != key]
    if not rest:
        return df
    return df.groupBy(*rest).agg(F.min(quoted(key)).alias(key)).select(*[quoted(c) for c in df.columns])


def drop_empty_rows(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Drop rows where every column is NULL (``exclude``: columns that do not count, such as a row key).

    The test names every column. As a plain filter it is pushed below computed
    projections, where constraint inference doubles its set with every alias; a
    condition on the partition id, which is always true, keeps it in its place.
    """
    out = set(exclude)
    filled = [quoted(c).isNotNull() for c in df.columns if c not in out]
    if not filled:
        return df
    some = filled[0]
    for c in filled[1:]:
        some = some | c
    return df.where(F.when(F.spark_partition_id() >= 0, some))


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.na.drop(subset=[target])


def fit_coerce_numeric(df: DataFrame, target: str | None = None, min_share: float = 0.90) -> list[str]:
    """String columns (but the target) where >= ``min_share`` of ALL rows parse as
    numbers. One aggregate job for all columns; returns the column names."""
    cands = [c for c in _string_cols(df) if c != target]
    if not cands:
        return []
    row = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(safe_double(quoted(c))).alias(f"__c{i}") for i, c in enumerate(cands)]
                 ).first()
    n = row["__n"] or 0
    if n == 0:
        return []
    return [c for i, c in enumerate(cands) if row[f"__c{i}"] / n >= min_share]


def apply_coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cs = set(columns)
    return df.select(*[safe_double(quoted(c)).alias(c) if c in cs else quoted(c)
                       for c in df.columns])


def coerce_numeric(df: DataFrame, target: str | None = None, min_share: float = 0.90) -> DataFrame:
    return apply_coerce_numeric(df, fit_coerce_numeric(df, target, min_share))


@dataclass
class ImputeStats:
    medians: dict = field(default_factory=dict)   # numeric column -> median (None if all NULL)
    modes: dict = field(default_factory=dict)     # other column -> mode text (UNKNOWN if none)
    with_nulls: set = field(default_factory=set)  # columns that hold a NULL


def fit_impute(df: DataFrame, exclude: Sequence[str] = (), fill_value: str = UNKNOWN) -> ImputeStats:
    """Medians of numeric columns and modes of the rest, only where NULLs exist.

    Jobs: one null-count aggregate, one exact-quantile plan, one mode plan.
    """
    cols = [c for c in df.columns if c not in set(exclude)]
    if not cols:
        return ImputeStats()
    row = df.agg(*[F.count_if(quoted(c).isNull() | (F.isnan(quoted(c)) if isinstance(
        df.schema[c].dataType, (T.FloatType, T.DoubleType)) else F.lit(False))).alias(f"__n{i}")
        for i, c in enumerate(cols)]).first()
    with_nulls = {c for i, c in enumerate(cols) if row[f"__n{i}"]}
    num = [c for c in cols if c in with_nulls and is_numeric_type(df.schema[c].dataType)
           and not isinstance(df.schema[c].dataType, T.BooleanType)]  # of booleans the mode
    other = [c for c in cols if c in with_nulls and c not in num]
    medians = {c: None for c in num}
    for r in exact_quantiles(df, num, [0.5]).collect():
        medians[r["column"]] = r["value"]
    modes = {c: fill_value for c in other}
    for r in column_modes(df, other).collect():
        modes[r["column"]] = r["value"]
    return ImputeStats(medians, modes, with_nulls)


def apply_impute(df: DataFrame, stats: ImputeStats) -> DataFrame:
    exprs = []
    for f in df.schema.fields:
        c = quoted(f.name)
        if f.name in stats.medians and stats.medians[f.name] is not None:
            v = F.lit(float(stats.medians[f.name]))
            if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
                c = F.when(~F.isnan(c), c)
            exprs.append(F.coalesce(c.cast("double"), v).alias(f.name))
        elif f.name in stats.modes:
            exprs.append(F.coalesce(c, F.lit(stats.modes[f.name]).cast(f.dataType)).alias(f.name))
        else:
            exprs.append(c)
    return df.select(*exprs)


def impute(df: DataFrame, exclude: Sequence[str] = (), fill_value: str = UNKNOWN) -> DataFrame:
    return apply_impute(df, fit_impute(df, exclude, fill_value))


def fit_label_encoder(df: DataFrame, target: str, max_labels: int = MAX_LABELS) -> list[str]:
    """Sorted distinct labels (as text) of ``target``; index = position. For the few
    classes of a learner; ``fit_label_table`` takes any number."""
    labels = df.select(quoted(target).cast("string").alias("l")).where(F.col("l").isNotNull()) \
        .distinct().limit(max_labels + 1).collect()
    if len(labels) > max_labels:
        raise ValueError(f"more than {max_labels} distinct labels in {target}")
    return sorted(r["l"] for r in labels)


def fit_label_table(df: DataFrame, target: str) -> DataFrame:
    """``(label, index)`` of the sorted distinct labels (as text), for any number of them; written once."""
    labels = df.select(quoted(target).cast("string").alias("label")).where("label IS NOT NULL").distinct()
    keyed = written(labels.withColumn("__sk", string_order_key(F.col("label"))), "labels")
    return written(row_positions(keyed, ["__sk", "label"], out="__pos").select("label", (F.col("__pos") - 1).cast("int").alias("index")), "label-table")


def apply_label_table(df: DataFrame, target: str, labels: DataFrame, out: str | None = None) -> DataFrame:
    """Map ``target`` to its index in ``labels``; an unseen label fails the job, naming it.

    ``labels`` has a row per label, however many: hot labels are joined where they
    lie, the others by shuffle. ``df`` is read three times.
    """
    out = out or target
    keyed = df.withColumn("__label", F.coalesce(quoted(target).cast("string"), F.lit("nan")))
    joined = join_unique(keyed, labels.select(F.col("label").alias("__label"), F.col("index").alias("__idx")), ["__label"], "left")
    message = F.concat(F.lit("a label without an index (fitted on other rows): "), F.col("__label"))
    index = F.when(F.col("__idx").isNull(), F.raise_error(message).cast("int")).otherwise(F.col("__idx"))
    # a filter is evaluated by every action, count() too
    joined = joined.where(index >= 0)
    return joined.select(*[F.col("__idx").alias(out) if c == out else quoted(c) for c in df.columns],
                         *([] if out in df.columns else [F.col("__idx").alias(out)]))


def labels_frame(spark, labels: Sequence[str], target: str, out: str) -> DataFrame:
    return spark.createDataFrame([(lab, i) for i, lab in enumerate(labels)],
                                 T.StructType([T.StructField("__label", T.StringType()),
                                               T.StructField(out, T.IntegerType())]))


def apply_label_map(df: DataFrame, target: str, labels: Sequence[str], out: str | None = None,
                    check_unseen: bool = True) -> DataFrame:
    """Map ``target`` to its index in ``labels``; unseen label -> error naming it.

    The label table is bounded by ``MAX_LABELS`` (checked at fit) and broadcast.
    """
    out = out or target
    spark = df.sparkSession
    if check_unseen:
        unseen = (df.select(quoted(target).cast("string").alias("__label")).distinct()
                  .join(F.broadcast(labels_frame(spark, labels, target, "__i")), "__label", "left_anti")
                  .limit(21).collect())
        if unseen:
            names = sorted("nan" if r["__label"] is None else r["__label"] for r in unseen)
            raise UnknownLabelError(f"labels without an index (fitted on other rows): {names[:20]}")
    lf = F.broadcast(labels_frame(spark, labels, target, "__idx"))
    joined = df.join(lf, df[target].cast("string") == lf["__label"], "left")
    return joined.select(*[F.col("__idx").alias(out) if c == out else df[f"`{c}`"]
                           for c in df.columns],
                         *([] if out in df.columns else [F.col("__idx").alias(out)]))
