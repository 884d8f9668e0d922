"""Missing-value rules shared by every operator.

pandas has a single missing marker; Spark has NULL *and* NaN. All readers and
numeric casts canonicalise NaN to NULL, and threshold tests are wrapped so that
a NULL comparison is false rather than NULL.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Placeholder tokens treated as missing (trimmed, lower-cased).
DEFAULT_NULL_TOKENS = ("", "?", "na", "n/a", "null", "none")

# Tokens the CSV reader of the reference already reads as missing.
CSV_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# A number as pandas.to_numeric accepts it: optional sign, digits with an
# optional fraction or a leading-dot fraction, optional exponent, or inf/nan.
NUMERIC_PATTERN = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|inf|infinity|nan)\s*$"

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES) or isinstance(dt, T.BooleanType)


def nan_to_null(c: Column) -> Column:
    """NaN -> NULL for a floating column expression."""
    return F.when(~F.isnan(c), c)


def canonical_nulls(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every float/double column, one projection."""
    exprs = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            exprs.append(nan_to_null(F.col(f"`{f.name}`")).alias(f.name))
        else:
            exprs.append(F.col(f"`{f.name}`"))
    return df.select(*exprs)


def safe_double(c: Column) -> Column:
    """``pd.to_numeric(errors="coerce")`` on a string: unparsable -> NULL.

    ``try_cast`` alone accepts Spark-only literals such as ``1d``; the pattern
    guard keeps only what pandas would parse. NaN becomes NULL.
    """
    s = c.cast("string")
    parsed = F.when(s.rlike(NUMERIC_PATTERN), F.trim(s).try_cast("double"))
    return nan_to_null(parsed)


def is_missing_token(c: Column, tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> Column:
    """True when the value is NULL or, trimmed and lowered, one of ``tokens``."""
    toks = sorted({str(t).strip().lower() for t in tokens})
    s = F.lower(strip_ws(c.cast("string")))
    return c.isNull() | F.coalesce(s.isin(toks), F.lit(False))


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def present(df, column: str, message: str):
    """``df``, which fails on evaluation if ``column`` holds a NULL.

    The check is a filter: unlike a column that nobody reads, it is evaluated by
    every action, ``count()`` included.
    """
    c = quoted(column)
    return df.where(F.when(c.isNotNull(), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))
