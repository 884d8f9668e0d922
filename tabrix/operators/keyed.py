"""Equi-joins of rows to a table with one row per key, safe for hot keys.

A key that holds more than ``1 / SHARE`` of all rows is *hot*. There are fewer
than ``SHARE`` hot keys whatever the input, so the other side's rows of those
keys are a broadcast of proven size, and hot rows are joined where they lie. All
other rows are shuffled by key, where no key exceeds that share.

Rows with a NULL in the key match nothing: an inner join drops them, a left join
keeps them in place with NULL values, without a shuffle. Column names may hold
anything; the value columns of ``unique`` must not clash with those of ``rows``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.functions.nulls import quoted
from tabrix.session import written

SHARE = 1000


def hot_keys(rows: DataFrame, on: list[str], share: int = SHARE) -> DataFrame:
    """The keys of more than ``1 / share`` of the rows: fewer than ``share``, written once."""
    counted = rows.groupBy(*map(quoted, on)).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    known = reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in on])
    return written(counted.where(known & (F.col("_n") * share > total)).select(*map(quoted, on)), "hot-keys")


def join_unique(rows: DataFrame, unique: DataFrame, on: list[str], how: str = "inner",
                hot: DataFrame | None = None) -> DataFrame:
    """``rows`` joined to ``unique`` (one row per key ``on``); ``how`` is ``inner`` or ``left``.

    ``rows`` is read up to three times: pass a written table. ``hot`` may hold
    its hot keys if several joins share them.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    hot = hot_keys(rows, on) if hot is None else hot
    known = reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in on])
    values = unique.join(F.broadcast(hot), on)  # at most as many rows as hot keys
    near = values if how == "inner" else hot.join(F.broadcast(values), on, "left")
    here = rows.where(known).join(F.broadcast(near), on, "inner")
    away = rows.where(known).join(F.broadcast(hot), on, "left_anti").join(unique, on, how)
    out = here.unionByName(away)
    if how == "left":
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in unique.schema.fields if f.name not in on]
        out = out.unionByName(rows.where(~known).select("*", *empty))
    return out
