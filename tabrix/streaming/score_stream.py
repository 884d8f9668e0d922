"""``score.stream``: the scoring of arriving rows as a Structured Streaming job.

Source: a folder of Parquet (or JSON-lines request) files; each micro-batch is
aligned to the model's input contract, transformed by the fitted
``PipelineModel`` (stateless) and appended to a Parquet sink. The checkpoint
location holds the source offsets and the sink commit log, so a restarted or
partially failed job neither loses nor duplicates output. ``availableNow``
processes everything present and stops (batch-like runs, tests); a
``processingTime`` trigger keeps it running.

``start_request_scoring`` takes JSON requests, one a line, that may be malformed or
arrive twice: requests that cannot be scored go to a quarantine with the reason,
a request id seen within the watermark is scored once, and every micro-batch
writes folders named by its id, which a repeated batch replaces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrix.operators.model import predict
from tabrix.operators.score import align, checked_requests


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema if fmt != "json-requests" else "value string")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "json-requests":
        raw = r.text(path)
        return raw.select(F.from_json("value", schema).alias("r")).select("r.*")
    return r.format(fmt).load(path)


def scored_stream(stream: DataFrame, model, expected: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return predict(model, align(stream, expected, keep), keep)


def start_scoring(spark: SparkSession, model, source: str, schema: T.StructType,
                  expected: Sequence[str], keep: Sequence[str], sink: str, checkpoint: str,
                  fmt: str = "parquet", available_now: bool = True, interval: str = "10 seconds"):
    """Start the scoring query; returns the ``StreamingQuery``."""
    scored = scored_stream(read_stream(spark, source, schema, fmt), model, expected, keep)
    w = scored.writeStream.format("parquet").option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start(sink)


def start_request_scoring(spark: SparkSession, model, source: str, schema: T.StructType, expected: Sequence[str],
                          request_id: str, event_time: str, sink: str, quarantine: str, checkpoint: str,
                          watermark: str = "1 hour", available_now: bool = True, interval: str = "10 seconds",
                          max_files_per_trigger: int | None = None):
    """Score JSON requests arriving in the folder ``source``; returns the ``StreamingQuery``.

    ``schema`` has the model's ``expected`` columns, the ``request_id`` and a
    timestamp ``event_time``. Scores (id, time, class, P(1)) go to
    ``sink/batch=<id>``, requests that cannot be scored with their reason to
    ``quarantine/batch=<id>``. A batch that ran before a failure is written again
    into the same folders, so nothing is lost or doubled. The state holds the ids of
    one ``watermark`` back; requests later than that are dropped as repeats are.
    """
    raw = read_lines(spark, source, max_files_per_trigger)
    rows = checked_requests(raw, schema, [*expected, request_id, event_time], [request_id, event_time])
    good = rows.where("reason IS NULL").withWatermark(event_time, watermark).dropDuplicatesWithinWatermark([request_id])
    both = good.unionByName(rows.where("reason IS NOT NULL"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        ok = align(batch.where("reason IS NULL"), expected, [request_id, event_time])
        predict(model, ok, [request_id, event_time]).write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch={batch_id}")
        bad = batch.where("reason IS NOT NULL").select("request", "reason")
        bad.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/batch={batch_id}")
        batch.unpersist()

    w = both.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()


def read_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files arriving in a folder, as ``value``."""
    r = spark.readStream.schema("value string")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(path)
