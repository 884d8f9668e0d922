"""Delta-maintained token counts by source, language and tokenizer version.

Totals are sums of signed deltas: an insert adds a document and its tokens, a
delete takes both away, a revised count adds the difference. ``signed`` turns
change rows into one delta row per (source, lang, version), summed map-side, so a
hot source costs a partition one row per task.

``Rollup`` keeps the deltas of each attempt at a batch in a folder of its own and
counts a batch only if its commit record exists. A commit writes the deltas first,
then the record, which names the attempt's folder; a batch that has a record is not
applied again, and no attempt touches what another wrote. Of two writers of one
batch whose records meet, the smaller folder counts (both hold the same deltas).
So a batch can be retried any number of times, from any number of places.

Totals are maintained: after every ``FOLD`` batches the totals so far are written
as a new *base* beside the list of folders that it covers, and a record of the next
generation makes it the one that is read. Later totals are the base and the deltas
that it does not cover. A base that is being written covers what was committed
when it began, so commits go on meanwhile.

Edge cases: NULL source, language or version is a group of its own; NULL counts
count as 0; repeated change rows are changes of their own (a batch is idempotent,
a row is not); groups whose documents and tokens are all gone are left out of the
totals; an empty batch commits and changes nothing; extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrix.llm.common import staged

GROUP = ("source", "lang", "version")
#: Committed batches after which a new base is written.
FOLD = 8
_DELTA = "source string, lang string, version string, documents bigint, tokens bigint"


def signed(changes: DataFrame) -> DataFrame:
    """Deltas of change rows (op, source, lang, version, tokens, old_tokens).

    ``op``: insert, delete (``tokens``: the count that goes) or revise (from
    ``old_tokens`` to ``tokens``); any other op is an error.
    """
    op, new, old = F.col("op"), F.coalesce("tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    wrong = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce(op, F.lit("NULL")))).cast("long")
    documents = F.when(op == "insert", 1).when(op == "delete", -1).when(op == "revise", 0).otherwise(wrong)
    tokens = F.when(op == "insert", new).when(op == "delete", -new).when(op == "revise", new - old).otherwise(wrong)
    return changes.groupBy(*GROUP).agg(F.sum(documents.cast("long")).alias("documents"),
                                       F.sum(tokens.cast("long")).alias("tokens"))


class Rollup:
    """A rollup kept in the folder ``path`` (any Hadoop URI that the executors share)."""

    def __init__(self, spark: SparkSession, path: str, fold: int = FOLD):
        self.spark, self.path, self.fold = spark, path.rstrip("/"), fold

    def _read(self, *parts: str, schema: str) -> DataFrame:
        where = "/".join((self.path, *parts))
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(where)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def batches(self) -> DataFrame:
        """(batch, folder) of the committed batches."""
        return self._read("commits", schema="batch string, folder string").groupBy("batch").agg(F.min("folder").alias("folder"))

    def committed(self, batch: str) -> bool:
        return not self.batches().where(F.col("batch") == batch).isEmpty()

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Apply a batch of ``signed`` deltas once; False if it was applied before."""
        if self.committed(batch):
            return False
        attempt = uuid.uuid4().hex
        rows = deltas.select(*GROUP, "documents", "tokens", F.lit(attempt).alias("folder"))
        rows.write.parquet(f"{self.path}/deltas/{attempt}")
        record = self.spark.range(1).select(F.lit(batch).alias("batch"), F.lit(attempt).alias("folder"))
        name = uuid.uuid5(uuid.NAMESPACE_URL, batch).hex
        try:
            record.coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/commits/{name}")
        except AnalysisException as e:
            if "PATH_ALREADY_EXISTS" not in str(e):
                raise
            return False  # another writer was first; these deltas are never read
        if self._open().count() >= self.fold:
            self.compact()
        return True

    def _base(self) -> tuple[int, str | None]:
        """(generation, folder) of the newest complete base."""
        bases = self._read("bases", schema="generation bigint, folder string")
        row = bases.orderBy(F.desc("generation"), "folder").first()
        return (row["generation"], row["folder"]) if row else (0, None)

    def _covered(self, base: str | None) -> DataFrame:
        return self._read("covers", base or "none", schema="folder string")

    def _open(self) -> DataFrame:
        """Folders of committed batches that the base does not cover."""
        return self.batches().select("folder").join(self._covered(self._base()[1]), "folder", "left_anti")

    def _sum(self, base: str | None, folders: DataFrame) -> DataFrame:
        deltas = self._read("deltas", schema=_DELTA + ", folder string").join(folders, "folder", "left_semi").drop("folder")
        counted = self._read("totals", base or "none", schema=_DELTA).unionByName(deltas)
        sums = counted.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return sums.where("documents != 0 or tokens != 0")

    def compact(self) -> None:
        """Write the totals of all batches that are committed now as the base of the next generation."""
        generation, base = self._base()
        folders = staged(self._open(), "rollup-folders")
        name = uuid.uuid4().hex
        self._sum(base, folders).write.parquet(f"{self.path}/totals/{name}")
        self._covered(base).unionByName(folders).write.parquet(f"{self.path}/covers/{name}")
        record = self.spark.range(1).select(F.lit(generation + 1).cast("long").alias("generation"), F.lit(name).alias("folder"))
        record.coalesce(1).write.parquet(f"{self.path}/bases/{name}")

    def totals(self) -> DataFrame:
        """(source, lang, version, documents, tokens) over all committed batches."""
        return self._sum(self._base()[1], self._open())
