"""Embedding whitening with a weighted covariance over distinct vectors.

Each entry ``c`` becomes the whole number ``floor(64 c) + 1000000``; vectors that
are equal on this grid are one *point* with a multiplicity.

1. Points are found by a grouped count (map-side combine: a vector repeated a
   billion times is one row per task). They weigh one or their multiplicity.
2. Weights and sums are exact whole numbers: per task a partial sum, added as
   decimals.
3. The covariance is a weighted GEMM over centred points, ``(n x - S) / n`` from
   exact whole numerators, task by task; rows of the partial matrices are shuffled
   by row number and added. The driver gets one ``d x d`` matrix, for its
   eigenvectors; ``d`` is the length of a vector and does not grow with the data.
4. Each point is whitened once: projected on the unit eigenvectors and divided by
   the roots of the eigenvalues. A second centred GEMM over the result measures how
   far its covariance is from the identity.
5. The rows get their point's values back by ``operators.keyed.join_unique`` on a SHA-256
   digest of the point, so a vector that fills a third of the table fills no task.

Edge cases: vectors that are NULL, hold NULL, NaN or an infinite entry, or an
entry whose grid value leaves 62 bits, are dropped; so are vectors of another
length than the most frequent one (ties: the longer). Directions without
variance (eigenvalue under ``1e-12`` of the largest) are no components, so one
point alone, or an empty table, gives an empty result. Repeated and NULL keys are
rows like others; extra columns pass through, an added name replaces an equal one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabrix.llm.common import fresh, staged
from tabrix.operators.keyed import join_unique

SCALE, OFFSET = 64, 1_000_000
#: Eigenvalues below this share of the largest are no variance.
FLAT = 1e-12
_SAFE = 1 << 62


def grid(df: DataFrame, vector: str, point: str, key: str) -> DataFrame:
    """``df`` without unusable vectors, with the grid ``point`` (whole numbers) and its digest ``key``."""
    v = F.col(vector)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * SCALE) >= float(_SAFE >> 1)))
    out = df.where(v.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    out = out.withColumn(point, F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET))
    return out.withColumn(key, F.unhex(F.sha2(F.array_join(F.transform(F.col(point), lambda x: x.cast("string")), ","), 256)))


def matrix(column: pa.ListArray, d: int) -> np.ndarray:
    """The lists of an Arrow column, all of length ``d``, as rows of one array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


@dataclass(frozen=True)
class Moments:
    """Weight ``n`` of all points and the exact sums ``S`` per dimension."""

    n: int
    sums: tuple[int, ...]

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exact: 64-bit where that holds it, whole Python numbers elsewhere."""
        most = max(int(np.abs(x).max(initial=0)) * self.n, max(map(abs, self.sums), default=0))
        kind = np.int64 if most < _SAFE >> 1 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.numerators(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of squares of ``n x - S`` per point, exact."""
        m = self.numerators(x)
        most = max(int(m.max(initial=0)), -int(m.min(initial=0)))
        if most * most * x.shape[1] >= _SAFE:
            m = m.astype(object)
        return [int(s) for s in (m * m).sum(axis=1)]


def _sums(points: DataFrame, d: int, weight: str) -> Moments:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (d + 1)
        for batch in batches:
            x, w = matrix(batch.column(0), d), batch.column(1).to_numpy()
            safe = int(np.abs(x).max(initial=0)) * int(w.sum()) < _SAFE
            part = w @ x if safe else w.astype(object) @ x.astype(object)
            total = [a + int(b) for a, b in zip(total, [*part, w.sum()], strict=True)]
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(d + 1), pa.int32()), "s": pa.array([str(t) for t in total])})

    parts = points.select("point", weight).mapInArrow(partial, "i int, s string")
    sums = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    got = {r["i"]: int(r["s"]) for r in sums.collect()}  # d + 1 rows
    return Moments(got.get(d, 0), tuple(got.get(i, 0) for i in range(d)))


def _gram(rows: DataFrame, d: int, centred) -> np.ndarray:
    """Sum of ``w c c'`` over all rows; ``centred`` turns a batch into (c, w)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            c, w = centred(batch)
            total += c.T @ (c * w[:, None])
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()), "row": pa.array([r.tobytes() for r in total], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[i] = total.get(i, 0.0) + np.frombuffer(row)
        yield pa.RecordBatch.from_pydict({"i": pa.array(list(total), pa.int32()), "row": pa.array([r.tobytes() for r in total.values()], pa.binary())})

    schema = "i int, row binary"
    added = rows.mapInArrow(partial, schema).repartition("i").mapInArrow(add, schema)
    out = np.zeros((d, d))
    for r in added.collect():  # d rows of d numbers
        out[r["i"]] = np.frombuffer(r["row"])
    return out


def principal(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) by falling eigenvalue, without flat directions.

    The sign is set by the entry of largest size, which is positive.
    """
    e, v = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-e, kind="stable")[:components]
    order = order[e[order] > FLAT * max(e.max(initial=0.0), 0.0)]
    v = v[:, order]
    return e[order], v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: moments, eigenvalues, their share of the trace, unit eigenvectors."""

    moments: Moments
    values: np.ndarray
    explained: np.ndarray
    vectors: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.moments.centred(x) @ (self.vectors / np.sqrt(self.values))


def fit(points: DataFrame, d: int, weight: str, components: int) -> Whitening:
    """Fit over ``points`` (``point`` array<bigint> of length ``d``, ``weight`` bigint); reads them twice."""
    moments = _sums(points, d, weight)

    def centred(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return moments.centred(matrix(batch.column(0), d)), batch.column(1).to_numpy()

    cov = _gram(points.select("point", weight), d, centred) / max(moments.n, 1)
    values, vectors = principal(cov, components)
    return Whitening(moments, values, values / max(np.trace(cov), np.finfo(float).tiny), vectors)


def _identity_error(white: DataFrame, k: int, n: int) -> float:
    """Largest entry of the covariance of the whitened points minus the identity."""
    sums = white.select(F.posexplode("whitened").alias("i", "w"), "weight").groupBy("i").agg(F.sum(F.col("w") * F.col("weight")).alias("s"))
    mean = np.zeros(k)
    for r in sums.collect():  # k rows
        mean[r["i"]] = r["s"] / n

    def centred(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return matrix(batch.column(0), k) - mean, batch.column(1).to_numpy()

    return float(np.abs(_gram(white.select("whitened", "weight"), k, centred) / n - np.eye(k)).max())


def whiten(df: DataFrame, vector: str, components: int = 16, weights: str = "one") -> DataFrame:
    """Usable rows without ``vector``, with ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    ``weights``: each distinct point weighs ``one``, or its ``count``.
    ``deviation`` is a decimal, ``whitened`` and ``explained`` have one entry per
    component. Rows without a component (see the edge cases) do not appear.
    """
    if weights not in ("one", "count"):
        raise ValueError(f"weights must be one or count, not {weights!r}")
    point, key = fresh(df, "point"), fresh(df, "point_id")
    rows = staged(grid(df, vector, point, key).drop(vector), "whitening-rows")
    grouped = rows.groupBy(F.col(key).alias("id"), F.col(point).alias("point")).agg(F.count(F.lit(1)).alias("copies"))
    weight = F.lit(1).cast("long") if weights == "one" else F.col("copies")
    points = staged(grouped.withColumn("weight", weight), "whitening-points")
    common = points.groupBy(F.size("point").alias("d")).agg(F.sum("copies").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    d = common["d"] if common else 0
    points = points.where(F.size("point") == d).select("point", "weight", "id")
    model = fit(points, d, "weight", components) if d else Whitening(Moments(0, ()), np.zeros(0), np.zeros(0), np.zeros((0, 0)))
    k = len(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0), d)
            white = model.apply(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), pa.array([str(v) for v in model.moments.deviations(x)], pa.string()), lists],
                                             names=["id", "weight", "deviation", "whitened"])

    white = points.where(F.lit(k > 0)).mapInArrow(project, "id binary, weight bigint, deviation string, whitened array<double>")
    white = staged(white, "whitened-points")
    error = _identity_error(white, k, model.moments.n) if k else 0.0
    taken = [c for c in ("n", "deviation", "whitened", "explained", "identity_error") if c in df.columns and c != vector]
    values = white.select(F.col("id").alias(key), F.lit(model.moments.n).cast("long").alias("n"), F.col("deviation").cast("decimal(38,0)").alias("deviation"),
                          "whitened", F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>").alias("explained"),
                          F.lit(error).alias("identity_error"))
    return join_unique(rows.drop(point, *taken), values, [key]).drop(key)
