"""Date functions: parse, parts, floored day differences, enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.functions.nulls import quoted

# Formats tried in order when a date column arrives as text (pandas guesses a
# format from the first value; we make the list explicit).
DEFAULT_DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy", "yyyy/MM/dd",
                        "dd-MM-yyyy")

MICROS_PER_DAY = 86_400_000_000


def parse_date(c: Column, dtype: T.DataType | None = None,
               formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """Text or date/time column -> naive wall-clock TIMESTAMP_NTZ; unparsable ->
    NULL (never raises). Naive values keep parts and day differences
    independent of the session time zone (no daylight-saving hour)."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    s = F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def date_parts(ts: Column, prefix: str) -> list[Column]:
    """``<prefix>_year``, ``<prefix>_month``, ``<prefix>_day`` (NULL stays NULL)."""
    return [
        F.year(ts).alias(f"{prefix}_year"),
        F.month(ts).alias(f"{prefix}_month"),
        F.dayofmonth(ts).alias(f"{prefix}_day"),
    ]


def diff_days(earlier: Column, later: Column) -> Column:
    """``floor((later - earlier) / 1 day)`` as INT, negative allowed.

    Same as pandas ``(b - a).dt.days``; unlike ``datediff`` it respects the time
    of day.
    """
    micros = F.timestamp_diff("MICROSECOND", earlier.cast("timestamp_ntz"),
                              later.cast("timestamp_ntz"))
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("int")


def enrich_dates(df: DataFrame, date_columns: Sequence[str], diff_pair: tuple[str, str] | None = None,
                 diff_name: str = "days_between",
                 formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> DataFrame:
    """``date.enrich``: parts of every present date column, the day difference of
    ``diff_pair`` when both are present, raw date columns dropped. One select."""
    present = [c for c in date_columns if c in df.columns]
    parsed = {c: parse_date(quoted(c), df.schema[c].dataType, formats) for c in present}
    keep = [quoted(c) for c in df.columns if c not in present]
    extra: list[Column] = []
    for c in present:
        extra.extend(date_parts(parsed[c], c))
    if diff_pair and diff_pair[0] in parsed and diff_pair[1] in parsed:
        extra.append(diff_days(parsed[diff_pair[0]], parsed[diff_pair[1]]).alias(diff_name))
    return df.select(*keep, *extra)
