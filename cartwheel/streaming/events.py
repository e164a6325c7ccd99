"""Event-time window aggregates over files that keep arriving.

One definition, :func:`windowed`, serves a stream and a batch. As a stream it
holds one state row per open window and key and gives it up when the watermark
passes. Two sinks, both exactly once:

* :func:`append_files`: a window is written when it is complete. The file sink's
  log names the files of every batch, so a batch that is repeated after a crash
  counts once;
* :func:`upsert_windows`: every batch updates the windows it touched in a keyed
  table. Windows are there before they are complete, and a repeated batch
  upserts the same rows, which changes nothing.

A stopped or lost query goes on from its checkpoint. Each call processes what
has arrived and returns (``availableNow``); run as a service, the same query
takes a processing-time trigger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartwheel.plans.parts import PartTable
from cartwheel.plans.upsert import upsert

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
KEYS = ["window_start", "event_type"]


def arriving(spark: SparkSession, folder: str, schema: str | T.StructType = EVENTS, max_files: int | None = None) -> DataFrame:
    """A stream of the Parquet files that land in ``folder``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def windowed(events: DataFrame, window: str = "1 hour", watermark: str | None = None) -> DataFrame:
    """``window_start, event_type, n_events, total_value`` of ``events(ts,
    event_type, value)``; values are summed as decimals, so the order of
    arrival does not show. Rows with a null time belong to no window. On a
    stream, rows that come later than ``watermark`` behind the latest time seen
    may find their window closed and are dropped. Watermarks need instants:
    times without a zone are taken in the session's (UTC by this library's
    settings) and given back without one."""
    kind = events.schema["ts"].dataType
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if watermark:
        events = events.withWatermark("ts", watermark)
    return events.groupBy(F.window("ts", window), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total_value")) \
        .select(F.col("window.start").cast(kind).alias("window_start"), "event_type", "n_events", "total_value")


def append_files(windows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Writes complete windows as Parquet files; ends when all files that have
    arrived are processed. Read them with ``spark.read.parquet(folder)``, which
    follows the sink's log."""
    query = windows.writeStream.format("parquet").outputMode("append").option("path", folder) \
                   .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def upsert_windows(windows: DataFrame, table: str, checkpoint: str, buckets: int = 16) -> StreamingQuery:
    """Keeps ``table`` (a :class:`~cartwheel.plans.parts.PartTable`) up to date
    with every batch's windows."""

    def merge(batch: DataFrame, _: int) -> None:
        batch = batch.persist()  # read by the key check and the merge
        try:
            upsert(PartTable(batch.sparkSession, table), batch, KEYS, buckets)
        finally:
            batch.unpersist()

    query = windows.writeStream.outputMode("update").foreachBatch(merge) \
                   .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
