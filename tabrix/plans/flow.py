"""End-to-end training flow: the studied pipeline's stages over one raw table (fits and checkpoints run as it is built).

split -> validate (+ gate) -> clean -> text / dates -> label encoding ->
feature frame -> cross-validated search -> evaluation -> drift -> retrain
signal. Statistics (coercion decision, medians, modes, labels) are fitted on
the train split and applied to both splits (``per_frame=True`` fits each split
on its own, as the studied code does).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.functions.dates import enrich_dates
from tabrix.functions.text import normalize_columns
from tabrix.operators import clean as C
from tabrix.operators import drift as DR
from tabrix.operators import evaluate as EV
from tabrix.operators import features as FE
from tabrix.operators import model as M
from tabrix.operators import quality as Q
from tabrix.operators import split as S
from tabrix.operators.contract import (CLAIMS_CONTRACT, CLAIMS_RULES, CLAIMS_TEXT_COLUMNS,
                                       QualityRules, TableContract)
from tabrix.session import materialize


@dataclass
class FlowConfig:
    key: str
    contract: TableContract = CLAIMS_CONTRACT
    rules: QualityRules = CLAIMS_RULES
    test_size: float = 0.25
    seed: int = 42
    text_columns: Sequence[str] = CLAIMS_TEXT_COLUMNS
    date_columns: Sequence[str] = ("policy_bind_date", "incident_date")
    date_diff: tuple[str, str] | None = ("policy_bind_date", "incident_date")
    date_diff_name: str = "policy_to_incident_days"
    renames: Mapping[str, str] = field(default_factory=lambda: dict(C.DEFAULT_RENAMES))
    value_maps: Mapping[str, Mapping[str, str]] = field(default_factory=lambda: dict(C.DEFAULT_VALUE_MAPS))
    combined_text: str = "combined_text"
    algorithm: str = "logistic_regression"
    params: Mapping = field(default_factory=lambda: {"maxIter": 20})
    grid: Mapping = field(default_factory=lambda: {"regParam": [0.01, 0.1]})
    folds: int = 5
    scaler: str = "none"
    per_frame: bool = False


@dataclass
class FlowResult:
    report: DataFrame
    summary: DataFrame
    train: DataFrame
    test: DataFrame
    manifest: dict
    labels: list
    search_summary: DataFrame
    predictions: DataFrame
    metrics: DataFrame
    confusion: DataFrame
    drift_features: DataFrame
    drift_summary: DataFrame
    concept: DataFrame


def clean_frame(df: DataFrame, cfg: FlowConfig, target: str, coerce_cols=None, stats=None):
    """The cleaning stage; returns ``(frame, coerce_cols, impute_stats)``."""
    d = C.rename_columns(df, cfg.renames)
    d = C.map_categories(C.trim_strings(d), cfg.value_maps)
    # every row has its own key: it is no part of what makes rows equal or empty, and is not coerced
    key = C.normalize_name(cfg.key)
    d = C.drop_empty_rows(C.drop_duplicates(C.null_tokens(d, cfg.rules.null_tokens), key), [key])
    d = C.drop_null_target(d, target)
    d = materialize(d)
    if coerce_cols is None:
        coerce_cols = [c for c in C.fit_coerce_numeric(d, target) if c != key]
    d = C.apply_coerce_numeric(d, coerce_cols)
    d = normalize_columns(d, list(cfg.text_columns))
    d = enrich_dates(d, list(cfg.date_columns), cfg.date_diff, cfg.date_diff_name)
    if stats is None:
        stats = C.fit_impute(d, exclude=[target, key])
    return C.apply_impute(d, stats), coerce_cols, stats


def training_flow(raw: DataFrame, cfg: FlowConfig) -> FlowResult:
    target = C.normalize_name(cfg.contract.target_column)
    key = C.normalize_name(cfg.key)  # the key's name once the columns are renamed
    split = materialize(S.stratified_split(raw, cfg.key, cfg.contract.target_column,
                                           cfg.test_size, cfg.seed, "__is_test"))
    train_raw = split.where(~F.col("__is_test")).drop("__is_test")
    test_raw = split.where(F.col("__is_test")).drop("__is_test")

    contract_cols = [c for c in raw.columns if c != cfg.key]
    report = Q.validate(train_raw.select(*contract_cols), "train", cfg.contract, cfg.rules) \
        .unionByName(Q.validate(test_raw.select(*contract_cols), "test", cfg.contract, cfg.rules))
    summary = Q.summarize(report)
    Q.gate(report)

    train, coerce_cols, stats = clean_frame(train_raw, cfg, target)
    if cfg.per_frame:
        test, _, _ = clean_frame(test_raw, cfg, target)
    else:
        test, _, _ = clean_frame(test_raw, cfg, target, coerce_cols, stats)

    labels = C.fit_label_encoder(train, target)
    train = C.apply_label_map(train, target, labels)
    test = C.apply_label_map(test, target, labels)

    text_sources = [C.normalize_name(c) for c in cfg.text_columns]
    train = FE.feature_frame(train, target, text_sources, cfg.combined_text)
    test = FE.feature_frame(test, target, text_sources, cfg.combined_text)
    manifest = FE.manifest(train.drop(key), target, cfg.combined_text)

    labelled = train.withColumn("label", F.col(target).cast("double"))
    folds = materialize(S.stratified_kfold(labelled, key, target, cfg.folds, cfg.seed))
    pipe = M.build_pipeline(manifest["numeric_columns"], manifest["categorical_columns"],
                            cfg.combined_text, cfg.algorithm, cfg.params, cfg.scaler)
    cv, maps = M.search(folds, pipe, cfg.grid, fold_col="fold", seed=cfg.seed,
                        num_folds=cfg.folds, parallelism=2)
    search_summary = M.search_summary(raw.sparkSession, cv, maps, cfg.algorithm)

    predictions = M.predict(cv.bestModel, test, keep=[key, target]) \
        .withColumnRenamed(target, "label")
    metrics = EV.binary_metrics(predictions, "label", "prediction", "probability")
    conf = EV.confusion(predictions, "label", "prediction")

    feats = DR.feature_drift(train.drop(key), test.drop(key), target)
    return FlowResult(report, summary, train, test, manifest, labels, search_summary,
                      predictions, metrics, conf, feats, DR.data_drift(feats),
                      DR.concept_drift(train, test, target))
