"""Batch scoring (the reference's HTTP predict endpoint, re-aimed at DataFrames)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.functions.nulls import quoted


class ScoringInputError(ValueError):
    pass


def expected_columns(manifest: dict) -> list[str]:
    """numeric + categorical + text, in that order (the model's input contract)."""
    cols = list(manifest.get("numeric_columns", [])) + list(manifest.get("categorical_columns", []))
    text = manifest.get("text_feature_column")
    if text:
        cols.append(text)
    return cols


def required_columns(df: DataFrame, expected: Sequence[str]) -> None:
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ScoringInputError(f"the model needs columns that the rows lack: {missing}")


def align(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Keep only the expected columns, in order (plus ``keep`` id columns)."""
    required_columns(df, expected)
    return df.select(*[quoted(c) for c in keep if c not in expected], *[quoted(c) for c in expected])


def score_batch(model, df: DataFrame, expected: Sequence[str], keep: Sequence[str] = (),
                reject_empty: bool = True) -> DataFrame:
    """Class and P(1) per row, keyed by ``keep`` columns; empty input rejected."""
    from tabrix.operators.model import predict

    aligned = align(df, expected, keep)
    if reject_empty and aligned.isEmpty():
        raise ScoringInputError("Input must contain at least one row")
    return predict(model, aligned, keep)


def parse_requests(raw: DataFrame, schema, value_col: str = "value") -> DataFrame:
    """JSON request rows (one object per line) -> typed columns."""
    parsed = raw.select(F.from_json(F.col(value_col), schema).alias("r"))
    return parsed.select("r.*")


def checked_requests(raw: DataFrame, schema: T.StructType, required: Sequence[str], not_null: Sequence[str] = (),
                     value_col: str = "value") -> DataFrame:
    """``(request, reason, columns of the schema)``: parsed JSON requests, and why one cannot be scored.

    ``reason`` is NULL for a good request. A request must be one JSON object whose
    values fit the schema, have every ``required`` name (its value may be NULL) and
    a value for each of ``not_null``.
    """
    broken = "__broken"
    full = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    read = F.from_json(F.col(value_col), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken})
    rows = raw.select(F.col(value_col).alias("request"), read.alias("r"), F.json_object_keys(F.col(value_col)).alias("names"))
    lacking = F.array_except(F.array(*map(F.lit, required)), F.col("names"))
    empty = F.filter(F.array(*[F.when(F.col(f"r.`{c}`").isNull(), F.lit(c)) for c in not_null]), lambda x: x.isNotNull()) if not_null else F.array()
    reason = F.when(F.col("names").isNull() | F.col(f"r.{broken}").isNotNull(), "not a JSON object of the expected types") \
        .when(F.size(lacking) > 0, F.concat(F.lit("lacks "), F.array_join(lacking, ", "))) \
        .when(F.size(empty) > 0, F.concat(F.lit("no value for "), F.array_join(empty, ", ")))
    return rows.select("request", reason.alias("reason"), *[F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields])
