"""Champion/challenger promotion ledger over an append-only runs table.

Input ``runs(model_name, env, version, score, should_retrain, ts)``; one output
row per run with the decision and the aliases after it. A run is promoted iff
it is not gated by ``should_retrain`` and strictly beats every earlier eligible
score (no earlier score -> promote). So the champion is always the earliest run
that holds the best eligible score so far, and the whole registry state before a
run is one value: the smallest ``(-score, order, version)`` of the eligible runs
before it. Minima are associative, so one running aggregate (``prefix.running``)
replaces the sequential registry updates; a hot (model, env) is spread over range
bins.

Aliases: every run becomes challenger at registration; a promoted run becomes
champion and the previous champion becomes challenger (none -> cleared).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.functions.nulls import present
from tabrix.operators.prefix import running


def version_key(df: DataFrame) -> DataFrame:
    """``version``, else legacy ``candidate_version``; rows with neither fail."""
    if "version" not in df.columns and "candidate_version" not in df.columns:
        raise KeyError("no column names the version of a run")
    cols = [F.col(c) for c in ("version", "candidate_version") if c in df.columns]
    found = df.withColumn("version", F.coalesce(*cols))
    return present(found, "version", "a registered run names no version").drop("candidate_version")


def ledger(runs: DataFrame, higher_is_better: bool = True, keys=("model_name", "env"),
           order=("ts", "version")) -> DataFrame:
    keys, order = list(keys), list(order)
    # a run without a score (NULL or NaN) is never the best and never promoted
    score = F.when(~F.isnan(F.col("score").cast("double")), F.col("score"))
    signed = score if higher_is_better else -score
    eligible = F.when(~F.coalesce(F.col("should_retrain"), F.lit(False)), signed)
    # the champion after a run: best score first, then the earliest run with it
    state = F.when(eligible.isNotNull(), F.struct((-eligible).alias("neg"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)],
                                                  F.col("version").alias("version")))
    ranked = running(runs, order, [("__state", "min", state)], partition_by=keys, inclusive=False)
    best = -F.col("__state.neg")
    promoted = eligible.isNotNull() & (F.col("__state").isNull() | (eligible > best))
    step2 = ranked.withColumns({"promoted": promoted, "champion_before": F.col("__state.version")})
    best_before = best if higher_is_better else F.col("__state.neg")
    decision = (F.when(F.coalesce(F.col("should_retrain"), F.lit(False)), F.lit("skipped_retrain"))
                .when(F.col("promoted"), F.lit("promote")).otherwise(F.lit("keep")))
    return step2.select(
        *[F.col(c) for c in runs.columns],
        best_before.alias("best_score_before"),
        decision.alias("decision"),
        F.when(F.col("promoted"), F.col("version")).otherwise(F.col("champion_before"))
        .alias("champion_after"),
        F.when(F.col("promoted"), F.col("champion_before")).otherwise(F.col("version"))
        .alias("challenger_after"),
    )


def current_aliases(ledger_df: DataFrame, keys=("model_name", "env"),
                    order=("ts", "version")) -> DataFrame:
    """Latest champion / challenger per key: ``max_by`` over the ledger (one
    partial aggregate per task, no per-key row gathering)."""
    o = F.struct(*[F.col(c) for c in order])
    return ledger_df.groupBy(*keys).agg(
        F.max_by("champion_after", o).alias("champion"),
        F.max_by("challenger_after", o).alias("challenger"),
        F.max(F.when(F.col("decision") == "promote", F.struct(*[F.col(c) for c in order],
                                                              F.col("score"))))["score"]
        .alias("champion_score"),
    )


def select_best(scores: DataFrame, group: str | None, candidate: str, score: str,
                order: str | None = None) -> DataFrame:
    """Highest score per group; ties go to the first candidate (smallest
    ``order``, default the candidate itself). Candidates without a score (NULL
    or NaN) do not count; both outputs come from one struct, by partial
    aggregation."""
    valid = scores.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    best = F.min(F.struct((-F.col(score)).alias("neg"), F.col(order or candidate).alias("tie"),
                          F.col(candidate).alias("candidate"), F.col(score).alias("score")))
    g = valid.groupBy(group) if group else valid.groupBy()
    cols = [group] if group else []
    return g.agg(best.alias("b")).select(*cols, F.col("b.candidate").alias("best_candidate"),
                                         F.col("b.score").alias("best_score"))
