"""Running aggregates over a global order, without a one-task window.

``Window.orderBy(x)`` with no partition (or a partition on a hot key) sends all
rows to a single task. Here each row gets a *range bin*: approximate quantile
bounds of the first numeric order key (at most ``num_bins - 1`` numbers, read
on the driver) and a binary-search ``Bucketizer`` place the row in one of
``num_bins`` value ranges. Because the bin is a pure function of the row, every
consumer of the plan sees the same bin (no reliance on exchange reuse), and a
hot group is spread over many bins. Then

1. each ``(group, bin)`` computes its *local* running aggregate with a window;
2. a small table of per-``(group, bin)`` totals gives, by a window over that
   small table, the carry-in from all earlier bins of the same group;
3. local value and carry-in are combined.

The small table has at most ``num_bins`` x ``groups`` rows (in practice
``num_bins + groups``). Callers must give an ``order_by`` that is a total order
within each group (add a unique key as the last column) for deterministic
results; equal values of the first key always share a bin.

Supported aggregate kinds: ``sum``, ``max``, ``min``, ``count`` (non-null) and
``last`` (last non-null value in order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.session import shuffle_partitions

_PID = "__rng_id"


def _local(kind: str, c: Column, frame) -> Column:
    if kind == "sum":
        return F.sum(c).over(frame)
    if kind == "count":
        return F.count(c).over(frame)
    if kind == "max":
        return F.max(c).over(frame)
    if kind == "min":
        return F.min(c).over(frame)
    if kind == "last":
        return F.last(c, ignorenulls=True).over(frame)
    raise ValueError(f"unsupported running aggregate: {kind}")


def _partial(kind: str, c: Column, order_struct: Column) -> Column:
    if kind == "sum":
        return F.sum(c)
    if kind == "count":
        return F.count(c)
    if kind == "max":
        return F.max(c)
    if kind == "min":
        return F.min(c)
    if kind == "last":
        # last non-null value of the range = value at the greatest order key
        # among rows where the value is present
        return F.max_by(c, F.when(c.isNotNull(), order_struct))
    raise ValueError(kind)


def _carry(kind: str, c: Column, frame) -> Column:
    if kind in ("sum", "count"):
        return F.sum(c).over(frame)
    if kind == "max":
        return F.max(c).over(frame)
    if kind == "min":
        return F.min(c).over(frame)
    if kind == "last":
        return F.last(c, ignorenulls=True).over(frame)
    raise ValueError(kind)


def _combine(kind: str, local: Column, carry: Column) -> Column:
    if kind in ("sum", "count"):
        return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
    if kind == "max":
        return F.greatest(local, carry)
    if kind == "min":
        return F.least(local, carry)
    if kind == "last":
        return F.coalesce(local, carry)
    raise ValueError(kind)


def _bin_key(df: DataFrame, name: str) -> Column:
    dt = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dt, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    raise TypeError(
        f"first order column {name!r} must be numeric, date or timestamp "
        f"(got {dt.simpleString()}); order by a numeric prefix first"
    )


def string_order_key(c: Column) -> Column:
    """Numeric key whose order agrees with the binary order of a string on its
    first 7.5 bytes (range-bin key for string ordering)."""
    h = F.rpad(F.substring(F.hex(F.encode(c, "UTF-8")), 1, 15), 15, "0")
    return F.conv(h, 16, 10).cast("decimal(20,0)").cast("double")


def range_bins(df: DataFrame, key: Column, num_bins: int, out: str = _PID,
               rel_error: float | None = None) -> DataFrame:
    """Add a deterministic value-range bin of ``key`` (0..num_bins-1, NULL -> -1).

    Bounds are approximate quantiles (one sketch job, ``num_bins - 1`` numbers
    to the driver); placement is a binary search in the JVM (``Bucketizer``).
    """
    from pyspark.ml.feature import Bucketizer

    tmp = "__bin_key"
    keyed = df.withColumn(tmp, key)
    probs = [i / num_bins for i in range(1, num_bins)]
    err = rel_error if rel_error is not None else 1.0 / (4 * num_bins)
    bounds = keyed.approxQuantile(tmp, probs, err) if probs else []
    uniq = sorted({b for b in bounds if b is not None and b == b and abs(b) != float("inf")})
    if not uniq:
        return keyed.withColumn(out, F.when(F.col(tmp).isNull(), F.lit(-1)).otherwise(F.lit(0))).drop(tmp)
    splits = [float("-inf"), *uniq, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol=tmp, outputCol="__bin_raw",
                          handleInvalid="keep").transform(keyed)
    return bucketed.withColumn(
        out, F.coalesce(F.col("__bin_raw").cast("int"), F.lit(-1))
    ).drop("__bin_raw", tmp)


def running(
    df: DataFrame,
    order_by: Sequence[str],
    aggs: Sequence[tuple[str, str, str | Column]],
    partition_by: Sequence[str] = (),
    inclusive: bool = True,
    num_bins: int | None = None,
) -> DataFrame:
    """Add running aggregates ``(out_name, kind, column)`` to ``df``.

    ``inclusive=True`` uses the frame ``[first row, current row]``; ``False``
    uses ``[first row, previous row]`` (NULL / 0 for the first row). The first
    ``order_by`` column must be numeric, date or timestamp.
    """
    spark = df.sparkSession
    n = num_bins or max(2, shuffle_partitions(spark))
    base = df
    value_cols = []
    for i, (_, _, c) in enumerate(aggs):
        name = f"__v{i}"
        base = base.withColumn(name, F.col(c) if isinstance(c, str) else c)
        value_cols.append(name)

    binned = range_bins(base, _bin_key(df, order_by[0]), n)

    upper = 0 if inclusive else -1
    local_frame = (
        Window.partitionBy(*partition_by, _PID)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, upper)
    )
    local = binned
    for i, (_, kind, _) in enumerate(aggs):
        local = local.withColumn(f"__l{i}", _local(kind, F.col(value_cols[i]), local_frame))

    order_struct = F.struct(*[F.col(k) for k in order_by])
    totals = binned.groupBy(*partition_by, _PID).agg(
        *[_partial(kind, F.col(value_cols[i]), order_struct).alias(f"__t{i}")
          for i, (_, kind, _) in enumerate(aggs)]
    )
    carry_frame = (
        Window.partitionBy(*partition_by).orderBy(_PID)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select(
        *partition_by, _PID,
        *[_carry(kind, F.col(f"__t{i}"), carry_frame).alias(f"__c{i}")
          for i, (_, kind, _) in enumerate(aggs)],
    )
    if not partition_by:
        # at most num_bins + 1 rows: a proven bound, safe to broadcast
        carry = F.broadcast(carry)
    join_keys = [local[k].eqNullSafe(carry[k]) for k in [*partition_by, _PID]]
    joined = local.join(carry, on=join_keys, how="left")
    out = joined.select(
        *[local[f"`{c}`"] for c in df.columns],
        *[_combine(kind, F.col(f"__l{i}"), F.col(f"__c{i}")).alias(name)
          for i, (name, kind, _) in enumerate(aggs)],
    )
    return out


def row_positions(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    out: str = "pos",
    num_bins: int | None = None,
) -> DataFrame:
    """1-based consecutive position of each row within its group in order.

    Equivalent to ``row_number() over (partition by g order by o)`` but spread
    over range partitions. ``order_by`` must be a total order inside a group.
    """
    return running(df, order_by, [(out, "count", F.lit(1))], partition_by,
                   inclusive=True, num_bins=num_bins)
