"""Sharding by a hierarchical weighted hash tree (native Spark expressions).

A row descends region, rack and shard. At every level each child draws
``-ln(u) / weight`` with ``u`` a hash of (key, child) in (0, 1), and the
smallest draw wins, so a child is taken with probability proportional to its
weight. A draw depends on nothing but the key, the child and the child's own
weight. Hence a changed weight moves rows only into (weight grown) or out of
(weight shrunk) that child, and inside every subtree whose weights did not
change each row keeps its place.

``HashTree.grown`` adds a shard as a region of its own: all other draws stay,
so rows move into the new shard and nowhere else (the ``key`` law). The shard
depends on the key and on the tree, which a shard count alone determines.

Hot keys: the draw is per row, no shuffle. Slots number the rows of a shard;
each shard is cut into ``buckets`` hash buckets, which are counted with map-side
combine and numbered on their own, so no task sorts a whole shard.

Edge cases: a NULL key is a key like any other (all NULL keys share a shard);
repeated rows get distinct slots; NULL text has zero bytes and the CRC of the
empty string; an empty table gives an empty result. Extra columns of the input
pass through ``assign``; the names it adds replace equal ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabrix.llm.common import fresh

#: Weight of a child that is not there: its draw is never the smallest.
_NEVER = 1.0e300


@dataclass(frozen=True)
class HashTree:
    """``regions[r][k]`` is the list of shard weights of rack ``k`` in region ``r``.

    Shards are numbered in reading order; their ids are ``first``-based and
    dense. Weights must be positive.
    """

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    def __post_init__(self):
        if not self.regions or any(not r or any(not k for k in r) for r in self.regions):
            raise ValueError("every region needs a rack and every rack a shard")
        if any(w <= 0 for r in self.regions for k in r for w in k):
            raise ValueError("shard weights must be positive")

    @staticmethod
    def regular(regions: int, racks: int, shards: int, weight: float = 1.0) -> HashTree:
        return HashTree(((((weight,) * shards),) * racks,) * regions)

    @property
    def shards(self) -> int:
        return sum(len(k) for r in self.regions for k in r)

    def grown(self, weight: float = 1.0) -> HashTree:
        """One more shard, in a new region: only rows that go to it move."""
        return HashTree((*self.regions, ((weight,),)))

    def reweighted(self, region: int, rack: int, shard: int, weight: float) -> HashTree:
        """The same tree with one weight changed; movement stays in that region's draws."""
        r = [[list(k) for k in x] for x in self.regions]
        r[region][rack][shard] = weight
        return HashTree(tuple(tuple(tuple(k) for k in x) for x in r))

    def shard_of(self, key: Column, seed: str = "tree") -> Column:
        """Shard id of ``key``: one weighted draw per level, as a Spark expression."""
        region_w = [sum(sum(k) for k in r) for r in self.regions]
        region = _pick(key, f"{seed}/region", [F.lit(float(w)) for w in region_w], F.lit(0))
        racks = max(len(r) for r in self.regions)
        rack_w = [[sum(k) for k in r] + [0.0] * (racks - len(r)) for r in self.regions]
        width = max(len(k) for r in self.regions for k in r)
        leaf_w, leaf_id, n = [], [], 0
        for r in self.regions:
            for j in range(racks):
                k = r[j] if j < len(r) else ()
                leaf_w.append([*map(float, k)] + [0.0] * (width - len(k)))
                leaf_id.append(n)
                n += len(k)

        def at(table: list, index: Column) -> Column:
            return F.element_at(F.array(*[F.lit(x) for x in table]), (index + 1).cast("int"))

        def leaf(path: Column) -> Column:
            pick = _pick(key, f"{seed}/shard", [at([w[j] for w in leaf_w], path) for j in range(width)], path)
            return (at(leaf_id, path) + pick).cast("int")

        def rack(reg: Column) -> Column:
            pick = _pick(key, f"{seed}/rack", [at([float(w[j]) for w in rack_w], reg) for j in range(racks)], reg)
            return F.transform(F.array(reg * racks + pick), leaf)[0]

        return F.transform(F.array(region), rack)[0]


def _pick(key: Column, salt: str, weights: list[Column], path: Column) -> Column:
    """Index of the child with the smallest weighted exponential draw."""
    draws = []
    for j, w in enumerate(weights):
        h = F.xxhash64(F.lit(salt), path.cast("long"), F.lit(j).cast("long"), key)
        u = (F.shiftrightunsigned(h, 11).cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
        draws.append(F.struct(F.when(w > 0, -F.log(u) / w).otherwise(F.lit(_NEVER)).alias("d"), F.lit(j).alias("j")))
    return F.array_min(F.array(*draws))["j"] if len(draws) > 1 else F.lit(0)


def assign(df: DataFrame, key: str, tree: HashTree, grown: HashTree | None = None,
           order: tuple[str, ...] = (), buckets: int = 64) -> DataFrame:
    """Add ``shard``, ``slot`` (gapless from 0 in each shard) and ``grown_shard``.

    ``order`` breaks ties of equal keys inside a bucket; ``buckets`` is the number
    of parts into which each shard is cut for numbering.
    """
    b, n, base = (fresh(df, x) for x in ("bucket", "rows_in", "base"))
    out = df.withColumn("shard", tree.shard_of(F.col(key)))
    out = out.withColumn("grown_shard", grown.shard_of(F.col(key)) if grown else F.lit(None).cast("int"))
    ties = [F.col(c) for c in order]
    # rows of one key differ in what breaks ties, so a repeated key does not fill a bucket
    out = out.withColumn(b, F.pmod(F.xxhash64(F.lit("bucket"), F.col(key), *ties), F.lit(buckets)).cast("int"))
    counts = out.groupBy("shard", b).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy("shard").orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", b, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base))
    place = F.row_number().over(Window.partitionBy("shard", b).orderBy(F.col(key), *ties))
    # starts has shards x buckets rows at most, whatever the input: a proven bound
    out = out.withColumn("slot", place.cast("long")).join(F.broadcast(starts), ["shard", b])
    return out.withColumn("slot", F.col("slot") + F.col(base) - 1).drop(b, base)
