"""Readers and writers: tables, reports, models.

* ``read_table``   – CSV (header) / Parquet / JSON, NA tokens -> NULL, NaN -> NULL,
                     fail when empty (one ``isEmpty`` probe, reads one row).
* ``require_inputs`` – named datasets must exist and be non-empty; produces
                     report rows instead of raising.
* ``write_table``  – overwrite-on-success via Spark's commit protocol.
* ``write_report`` / ``read_report`` – JSON reports (``FAILFAST`` on read).
* ``save_model`` / ``load_model`` – MLlib persistence.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.functions.nulls import CSV_NA_TOKENS, canonical_nulls, present, quoted


class EmptyInputError(ValueError):
    """Raised when a required table has no rows."""


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def _na_to_null(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    toks = list(tokens)
    exprs = []
    for f in df.schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, T.StringType):
            exprs.append(F.when(~c.isin(toks), c).alias(f.name))
        else:
            exprs.append(c)
    return df.select(*exprs)


def _typed(df: DataFrame) -> DataFrame:
    """String columns as the narrowest type that all their values parse as."""
    kinds = ("bigint", "double", "boolean")
    flags = [F.every(quoted(c).isNull() | F.expr(f"try_cast(trim(`{c}`) AS {k})").isNotNull()).alias(f"{i}_{k}")
             for i, c in enumerate(df.columns) for k in kinds]
    filled = [F.count(quoted(c)).alias(f"{i}_n") for i, c in enumerate(df.columns)]
    row = df.agg(*flags, *filled).first()
    out = []
    for i, c in enumerate(df.columns):
        kind = next((k for k in kinds if row[f"{i}_n"] and row[f"{i}_{k}"]), None)
        out.append(F.expr(f"try_cast(trim(`{c}`) AS {kind})").alias(c) if kind else quoted(c))
    return df.select(*out)


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    na_tokens: Sequence[str] = CSV_NA_TOKENS,
    require_rows: bool = True,
    label: str = "table",
) -> DataFrame:
    """Read a table and apply the missing-value rules of the reference reader.

    CSV: header row, every NA token -> NULL; without an explicit schema, columns
    are typed by the values that are left (one pass): bigint, double, boolean or
    string. All formats: NaN -> NULL.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = reader.option("header", True).option("mode", "PERMISSIVE").option("nanValue", "NaN").csv(path)
        df = _na_to_null(df, na_tokens)
        if schema is None:
            df = _typed(df)
    elif fmt == "json":
        df = reader.option("mode", "FAILFAST").json(path)
    elif fmt == "parquet":
        df = reader.parquet(path)
    else:
        df = reader.format(fmt).load(path)
    df = canonical_nulls(df)
    if require_rows and df.isEmpty():
        raise EmptyInputError(f"no rows in {label} at {path}")
    return df


def require_inputs(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """One report row per named input: exists and has rows.

    Columns ``dataset, check_name, column_name, observed, threshold, passed,
    message`` (the quality-report schema). Never raises for a missing file.
    """
    from tabrix.operators.quality import REPORT_SCHEMA

    rows = []
    for name, path in paths.items():
        if not _path_exists(spark, path):
            rows.append((name, "input_exists", None, 0.0, 1.0, False,
                         f"{name}: nothing at {path}"))
            continue
        empty = spark.read.format(fmt).load(path).isEmpty()
        rows.append((name, "input_not_empty", None, 0.0 if empty else 1.0, 1.0, not empty,
                     f"{name}: no rows at {path}" if empty else None))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] | None = None, mode: str = "overwrite") -> None:
    """Replace-on-success write; the job commit makes the output appear atomically."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_report(report: DataFrame, path: str, fmt: str = "json") -> None:
    """Persist a report DataFrame (rows = checks / metrics) as JSON or Parquet."""
    write_table(report, path, fmt=fmt)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str,
                required: Iterable[str] = ()) -> DataFrame:
    """Read a JSON report with a fixed schema; malformed records fail the job.

    ``required`` columns must be non-NULL in every row (checked lazily: the
    returned frame raises on evaluation).
    """
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    for name in required:
        if name not in df.columns:
            raise KeyError(f"the report schema has no {name}")
        df = present(df, name, f"a report row has no {name}")
    return df


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
