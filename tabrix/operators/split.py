"""Deterministic, exact splits and samples.

Row order inside a stratum is ``md5('<seed>:<key>')`` (ties by key), identical
in Spark and in SQL. Per-stratum test counts follow the largest-remainder rule:
``n_test = ceil(n * test_size)``; each class gets ``floor(n_c * test_size)``
and the leftover goes to the largest fractional parts (ties: class ascending).

``stratified_split`` ranks no rows. Hashes are counted by class and by their
leading ``BITS`` bits (map-side combine); a class's test rows are those before
one boundary, which lies in one bin. Only the rows of that bin are looked at
again: counted by the next bits until a bin is small, then ordered. Membership is
a comparison with the boundary of the row's class. Class tables stay DataFrames,
whatever the number of classes.

Positions (``stratified_kfold``) come from ``prefix.row_positions``: the hash
prefix is the range key, so even a stratum holding a third of all rows is spread
over every task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrix.functions.nulls import quoted
from tabrix.operators.prefix import row_positions
from tabrix.session import written

#: Leading bits of the hash that one histogram tells apart.
BITS = 12
#: A bin of at most so many rows is put in order.
SMALL = 10_000
DEFAULT_SEED = 42


def hash_key(key: str, seed: int = DEFAULT_SEED) -> Column:
    """``md5('<seed>:<key>')`` as lowercase hex (same as SQL ``md5``)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), quoted(key).cast("string")))


def _hash_cols(df: DataFrame, key: str, seed: int) -> DataFrame:
    h = hash_key(key, seed)
    return df.withColumn("__h", h).withColumn(
        "__hp", F.conv(F.substring("__h", 1, 15), 16, 10).cast("long"))


def allocate(counts: dict, test_size: float) -> dict:
    """Largest-remainder allocation of ``ceil(n * test_size)`` test rows to a few classes."""
    n = sum(counts.values())
    n_test = math.ceil(n * test_size)
    base = {c: math.floor(k * test_size) for c, k in counts.items()}
    left = n_test - sum(base.values())
    order = sorted(counts, key=lambda c: (-(counts[c] * test_size - math.floor(counts[c] * test_size)),
                                          "" if c is None else str(c)))
    for c in order[:max(0, left)]:
        base[c] += 1
    return base


def allocate_classes(sizes: DataFrame, test_size: float) -> DataFrame:
    """The same for a table of any number of classes: ``(cls, k)`` of ``(cls, n)``: largest-remainder allocation of ``ceil(sum(n) * test_size)`` test rows."""
    share = F.col("n") * F.lit(float(test_size))
    parts = written(sizes.select("cls", F.floor(share).alias("base"), (share - F.floor(share)).alias("rest"), "n"), "class-shares")
    left = parts.agg(F.ceil(F.sum("n") * F.lit(float(test_size))) - F.sum("base")).scalar()
    # ranked without a one-task window: classes may be many
    ranked = row_positions(parts.withColumn("neg", -F.col("rest")), ["neg", "cls"], out="place")
    return ranked.select("cls", (F.col("base") + F.when(F.col("place") <= left, 1).otherwise(0)).alias("k"))


def _class_name(c: Column) -> Column:
    """Text of a class, NULL included; NULL sorts first."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def _boundaries(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(cls, last_h, last_key)``: the ``k``-th smallest ``(h, key)`` of each class of ``rows (cls, h, key)``.

    ``wanted`` has ``(cls, k)`` with ``k >= 1``. Each round reads the rows of one
    bin per class; a bin holds about ``2 ** -BITS`` of its class.
    """
    found, shift = [], 60 - BITS
    while True:
        # 60 of the 128 bits of the hash; hashes that agree in all of them are put in order with the key
        part = F.conv(F.substring("h", 1, 15), 16, 10).cast("long")
        binned = rows.withColumn("bin", F.shiftright(part, max(shift, 0)))
        counts = binned.groupBy("cls", "bin").agg(F.count(F.lit(1)).alias("c"))
        order = Window.partitionBy("cls").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        # at most 2 ** BITS bins per class and round
        cum = counts.withColumn("cum", F.sum("c").over(order))
        hit = cum.join(wanted, "cls").where((F.col("cum") >= F.col("k")) & (F.col("cum") - F.col("c") < F.col("k")))
        hit = written(hit.select("cls", "bin", "c", (F.col("k") - F.col("cum") + F.col("c")).alias("k")), "boundary-bins")
        rows = written(binned.join(hit.select("cls", "bin"), ["cls", "bin"]).select("cls", "h", "key"), "boundary-rows")
        done = (F.col("c") <= SMALL) | F.lit(shift <= 0)
        place = F.row_number().over(Window.partitionBy("cls").orderBy("h", "key"))
        ready = rows.join(hit.where(done).select("cls", "k"), "cls").withColumn("place", place).where("place = k")
        found.append(written(ready.select("cls", F.col("h").alias("last_h"), F.col("key").alias("last_key")), "boundaries"))
        wanted = hit.where(~done).select("cls", "k")
        if wanted.isEmpty():
            break
        shift -= BITS
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _check_test_size(test_size: float) -> None:
    if not 0.0 < float(test_size) < 1.0:
        raise ValueError(f"test_size must be in (0, 1), got {test_size}")


def stratified_split(df: DataFrame, key: str, class_col: str | None, test_size: float = 0.25,
                     seed: int = DEFAULT_SEED, out: str = "is_test") -> DataFrame:
    """Add boolean ``out``: the exact per-class test membership.

    ``class_col=None`` gives the plain random split (one stratum).
    """
    _check_test_size(test_size)
    cls = _class_name(quoted(class_col)) if class_col else F.lit("")
    rows = df.select(cls.alias("cls"), hash_key(key, seed).alias("h"), quoted(key).alias("key"))
    sizes = written(rows.groupBy("cls").agg(F.count(F.lit(1)).alias("n")), "class-sizes")
    if class_col:
        wanted = allocate_classes(sizes, test_size)
    else:
        wanted = sizes.select("cls", F.ceil(F.col("n") * F.lit(float(test_size))).alias("k"))
    last = _boundaries(rows, written(wanted.where("k > 0"), "class-counts"))
    at = F.struct(hash_key(key, seed).alias("h"), quoted(key).alias("k"))
    if not class_col:
        # one boundary: part of the plan
        end = last.select(F.struct(F.col("last_h").alias("h"), F.col("last_key").alias("k"))).scalar()
        return df.select(*[quoted(c) for c in df.columns], F.coalesce(at <= end, F.lit(False)).alias(out))
    # one row per class, however many there are: no hint, Spark broadcasts it when it is small
    name = "__cls"
    ends = last.select(F.col("cls").alias(name), F.struct(F.col("last_h").alias("h"), F.col("last_key").alias("k")).alias("__end"))
    joined = df.withColumn(name, cls).join(ends, name, "left")
    return joined.select(*[quoted(c) for c in df.columns], F.coalesce(at <= F.col("__end"), F.lit(False)).alias(out))


def random_split(df: DataFrame, key: str, test_size: float = 0.25, seed: int = DEFAULT_SEED,
                 out: str = "is_test") -> DataFrame:
    return stratified_split(df, key, None, test_size, seed, out)


def split_frames(df: DataFrame, key: str, class_col: str | None, test_size: float = 0.25,
                 seed: int = DEFAULT_SEED) -> tuple[DataFrame, DataFrame]:
    """(train, test) DataFrames. Both are filters of one deterministic flagged
    plan, so recomputing either half (or a lost task) gives the same rows."""
    flagged = stratified_split(df, key, class_col, test_size, seed, "__is_test")
    return (flagged.where(~F.col("__is_test")).drop("__is_test"),
            flagged.where(F.col("__is_test")).drop("__is_test"))


def stratified_kfold(df: DataFrame, key: str, class_col: str | None, k: int = 5,
                     seed: int = DEFAULT_SEED, out: str = "fold") -> DataFrame:
    """Fold id 0..k-1: in-class hash rank modulo k (balanced within every class)."""
    if k < 2:
        raise ValueError("k must be at least 2")
    strata = [class_col] if class_col else []
    ranked = row_positions(_hash_cols(df, key, seed), ["__hp", "__h", key], strata, out="__pos")
    return ranked.select(*[quoted(c) for c in df.columns],
                         ((F.col("__pos") - 1) % k).cast("int").alias(out))


def sample_n(df: DataFrame, n: int, key: str, seed: int = DEFAULT_SEED) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement: the ``n`` smallest
    hashes (a bounded top-k, no full sort)."""
    return _hash_cols(df, key, seed).orderBy("__h", key).limit(n).drop("__h", "__hp")


def sample_by(df: DataFrame, class_col: str, fractions: dict, seed: int = DEFAULT_SEED) -> DataFrame:
    """Fast approximate stratified sample (Bernoulli per row)."""
    return df.sampleBy(class_col, fractions, seed)
