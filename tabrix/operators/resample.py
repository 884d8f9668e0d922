"""Seeded oversampling of minority classes (``oversample_nominal``).

Every class is raised to the size of the largest class. Within a class rows are
ordered by ``md5('<seed>:<key>')``; with ``extra = n_max - n_c`` every row gets
``extra // n_c`` copies and the first ``extra % n_c`` rows one more, so the
result is exact and reproducible. Copies are generated in two steps (chunks of
at most ``CHUNK`` copies are spread over partitions, then expanded) so that a
tiny class that must be multiplied many times is not expanded in one task.
A table with one class gets no copies.

``oversample_repeat`` copies the row itself. ``oversample_neighbours`` makes each
copy from the row's nearest neighbours of its own class, for nominal columns:

1. A value-difference table holds, per column and value, the share of each class
   among the rows with that value, in whole millionths. Two values differ by the
   sum over classes of the differences of their shares; two rows by the sum over
   columns of the squares. All of it is whole numbers, so results do not depend on
   the order of summation.
2. Shares place a row in a space where that distance is small only if all
   projections are close. Rows of a class are put in order along each of
   ``projections`` fixed pseudo-random projections (``prefix.row_positions``: no
   task sorts a class), and a row's candidates are the ``window`` rows before and
   after it in each order. So a row meets at most ``2 * projections * window``
   others, however many rows share its block of values.
3. The ``k`` nearest candidates give each nominal column their most frequent
   value (ties: the smallest text).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrix.functions.nulls import quoted
from tabrix.operators.keyed import join_unique
from tabrix.operators.prefix import row_positions
from tabrix.operators.split import DEFAULT_SEED, _class_name, _hash_cols
from tabrix.session import written

CHUNK = 4096
#: Shares are whole numbers of this many parts.
PARTS = 1_000_000
#: Rows of one order that a task sees together.
BLOCK = 8192


def _with_copies(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """``df`` with ``__copies``: how many rows each row has to add."""
    sizes = df.groupBy(quoted(label).alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    ranked = row_positions(_hash_cols(df, key, seed), ["__hp", "__h", key], [label], out="__pos")
    # one row per class, however many there are: no hint, Spark broadcasts it when it is small
    sized = ranked.join(sizes, quoted(label).eqNullSafe(F.col("__c")), "left")
    largest = sizes.agg(F.max("__n")).scalar()
    n_cls = F.col("__n")
    extra = largest - n_cls
    copies = (F.floor(extra / n_cls) + F.when(F.col("__pos") <= extra % n_cls, 1).otherwise(0)) \
        .cast("long")
    return sized.withColumn("__copies", copies)


def _expand(base: DataFrame, cols: Sequence[Column], key: str, copy_col: str) -> DataFrame:
    """The rows of ``base``, each ``__copies`` times, numbered from 1."""
    chunks = base.where(F.col("__copies") > 0).select(
        *cols, "__copies",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("__copies") - 1) / CHUNK).cast("long")))
        .alias("__chunk"))
    spread_chunks = chunks.repartition(quoted(key), "__chunk")
    lo = F.col("__chunk") * CHUNK + 1
    hi = F.least(F.col("__copies"), F.col("__chunk") * CHUNK + CHUNK)
    names = [c for c in spread_chunks.columns if c not in ("__copies", "__chunk")]
    return spread_chunks.select(*map(quoted, names), F.explode(F.sequence(lo, hi)).alias(copy_col))


def oversample_repeat(df: DataFrame, label: str, key: str, seed: int = DEFAULT_SEED,
                      copy_col: str = "copy_id") -> DataFrame:
    """Original rows (``copy_id`` 0) plus generated copies (1, 2, ...)."""
    base = _with_copies(df, label, key, seed)
    cols = [quoted(c) for c in df.columns]
    originals = base.select(*cols, F.lit(0).cast("long").alias(copy_col))
    return originals.unionByName(_expand(base, cols, key, copy_col))


def _coefficient(projection: int, column: Column, cls: Column) -> Column:
    """A fixed whole number in -1000..1000 per projection, column and class."""
    h = F.md5(F.concat_ws(":", F.lit(str(projection)), column, cls))
    return F.conv(F.substring(h, 1, 7), 16, 10).cast("long") % 2001 - 1000


def value_differences(df: DataFrame, label: str, columns: Sequence[str], projections: int) -> DataFrame:
    """``(column, value, shares, p0, p1, ...)``: class shares of each value, and its place along the projections.

    ``shares`` has an entry per class, classes ascending; values and classes are
    texts that tell NULL from the empty string.
    """
    long = df.select(_class_name(quoted(label)).alias("cls"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _class_name(quoted(c)).alias("value")) for c in columns])).alias("s")) \
        .select("cls", "s.column", "s.value")
    seen = long.groupBy("column", "value", "cls").agg(F.count(F.lit(1)).alias("c"))
    classes = written(df.select(_class_name(quoted(label)).alias("cls")).distinct().withColumn("zero", F.lit(0)), "classes")
    place = row_positions(classes, ["zero", "cls"], out="place").select("cls", "place")
    n_classes = F.lit(classes.count())
    each = seen.join(place, "cls")
    of_value = each.groupBy("column", "value").agg(
        F.sum("c").alias("n"), F.collect_list(F.struct("place", "cls", "c")).alias("by_class"))  # a row per class
    share = lambda x: F.floor(x["c"] * PARTS / F.col("n"))
    shares = F.transform(F.sequence(F.lit(1), n_classes), lambda i: F.aggregate(
        F.col("by_class"), F.lit(0).cast("long"), lambda a, x: a + F.when(x["place"] == i, share(x)).otherwise(0)))

    def along(p: int) -> Column:
        term = lambda a, x: a + share(x) * _coefficient(p, F.col("column"), x["cls"])
        return F.aggregate(F.col("by_class"), F.lit(0).cast("long"), term).alias(f"p{p}")

    return of_value.select("column", "value", shares.alias("shares"), *map(along, range(projections)))


def _distance(a: Column, b: Column) -> Column:
    """Sum over columns of the squared difference of two rows' values."""
    def apart(x: Column, y: Column) -> Column:
        d = F.aggregate(F.zip_with(x["shares"], y["shares"], lambda s, t: F.abs(s - t)), F.lit(0).cast("long"), lambda u, v: u + v)
        return F.transform(F.array(d), lambda v: v * v)[0]

    return F.aggregate(F.zip_with(a, b, apart), F.lit(0).cast("long"), lambda u, v: u + v)


def nearest(rows: DataFrame, k: int, projections: int, window: int) -> DataFrame:
    """``(cls, key, near)``: up to ``k`` nearest candidates of each row, as ``(d, h, key, profile)`` in order.

    ``rows`` has ``(cls, key, hp, h, profile, p0, p1, ...)``.
    """
    found = None
    me = F.struct("place", "h", "key", "profile")
    for p in range(projections):
        ranked = row_positions(rows, [f"p{p}", "hp", "h", "key"], ["cls"], out="place")
        home = F.floor(F.col("place") / BLOCK)
        # a row near the edge of a block is seen by the next block as well
        seen_by = F.array_distinct(F.array(F.floor((F.col("place") - window) / BLOCK), home, F.floor((F.col("place") + window) / BLOCK)))
        dealt = ranked.select("cls", "place", "h", "key", "profile", home.alias("home"), F.explode(seen_by).alias("block"))
        around = Window.partitionBy("cls", "block").orderBy("place").rowsBetween(-window, window)
        met = dealt.withColumn("met", F.collect_list(me).over(around)).where("block = home")
        others = F.filter("met", lambda x: x["place"] != F.col("place"))
        near = F.transform(others, lambda x: F.struct(_distance(F.col("profile"), x["profile"]).alias("d"), x["h"].alias("h"),
                                                      x["key"].alias("key"), F.transform(x["profile"], lambda v: v["value"]).alias("values")))
        part = met.select("cls", "key", F.slice(F.sort_array(near), 1, k).alias("near"))
        found = part if found is None else found.unionByName(part)
    best = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("near")))), 1, k)  # projections x k candidates
    return found.groupBy("cls", "key").agg(best.alias("near"))


def _mode(values: Column) -> Column:
    """Most frequent element; ties: the smallest."""
    counted = F.transform(F.array_distinct(values), lambda v: F.struct(
        (-F.size(F.filter(values, lambda x: x == v))).alias("c"), v.alias("v")))
    return F.array_min(counted)["v"]


def oversample_neighbours(df: DataFrame, label: str, key: str, columns: Sequence[str], k: int = 5,
                          seed: int = DEFAULT_SEED, projections: int = 4, window: int = 10,
                          copy_col: str = "copy_id") -> DataFrame:
    """Original rows (``copy_id`` 0) plus rows made from their neighbours (1, 2, ...).

    ``columns`` are nominal; the others (and the key) are copied from the row that a
    copy starts from. ``key`` is unique. A row that is alone in its class is copied
    as it is. ``df`` is read several times.
    """
    cols = [quoted(c) for c in df.columns]
    base = written(_with_copies(df, label, key, seed), "oversampling-base")
    table = written(value_differences(df, label, columns, projections), "value-differences")
    # only classes that grow need neighbours
    small = base.where(F.col("__n") < base.agg(F.max("__n")).scalar()).select(
        _class_name(quoted(label)).alias("cls"), quoted(key).alias("key"), F.col("__hp").alias("hp"), F.col("__h").alias("h"),
        F.posexplode(F.array(*[F.struct(F.lit(c).alias("column"), _class_name(quoted(c)).alias("value")) for c in columns])).alias("f", "s"))
    small = written(small.select("cls", "key", "hp", "h", "f", "s.column", "s.value"), "oversampling-values")
    placed = join_unique(small, table, ["column", "value"])
    rows = placed.groupBy("cls", "key", "hp", "h").agg(
        F.sort_array(F.collect_list(F.struct("f", "value", "shares"))).alias("profile"),  # an entry per column
        *[F.sum(f"p{p}").alias(f"p{p}") for p in range(projections)])
    near = written(nearest(written(rows, "oversampling-rows"), k, projections, window).select("key", "near"), "oversampling-neighbours")
    votes = lambda i: F.transform("near", lambda x: F.get(x["values"], F.lit(i)))
    made = near.select(F.col("key").alias("__key"), *[_mode(votes(i)).alias(f"__v{i}") for i in range(len(columns))])
    joined = base.where("__copies > 0").join(made, quoted(key) == F.col("__key"), "left")
    place = {c: i for i, c in enumerate(columns)}

    def value(c: str) -> Column:
        if c not in place:
            return quoted(c)
        v = F.col(f"__v{place[c]}")
        text = F.when(v == "", F.lit(None)).otherwise(F.substring(v, 2, 1 << 30))
        return F.when(v.isNull(), quoted(c)).otherwise(text.cast(df.schema[c].dataType)).alias(c)

    originals = base.select(*cols, F.lit(0).cast("long").alias(copy_col))
    return originals.unionByName(_expand(joined, [value(c) for c in df.columns], key, copy_col))
