"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.session import checkpoint_dir

#: ASCII white space, the word separator of most operators here.
SPACE = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    The written table cuts the lineage: a lost executor costs no recomputation,
    and every later reader sees the same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(sizes, most: int):
    """(start, end) ranges of consecutive items of about ``most`` bytes together."""
    start = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def texts_of(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; NULL counts as empty."""
    import pyarrow as pa

    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def give_back() -> None:
    """Freed memory goes back to the system: Arrow's pool, and the C heap where its library can."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run):
    """``run`` of ``mapInArrow``, which gives its memory back when a task ends.

    Python workers wait for later tasks, also of other stages, and would keep it.
    """

    def to_the_end(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return to_the_end
