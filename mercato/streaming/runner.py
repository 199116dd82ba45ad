"""Structured Streaming wiring for the windowed metrics.

One streaming query per metrics stream: event-time watermark, sliding
window aggregate in the built-in state store, ``update`` output, and a
``foreachBatch`` sink that fans one persisted micro-batch out to every
configured output (the reference ran two independent queries with two
states, one of them without a checkpoint).

The file sink of each micro-batch goes to ``<out>/batch_id=<N>/`` with
overwrite, so a batch replayed after a failure replaces its own output
instead of appending a second copy; other sinks get a batch once by their
tokens (:mod:`mercato.streaming.sinks`). :func:`compact_updates` turns the
update rows into the latest value per (window, code), in one fold;
:mod:`mercato.streaming.compaction` does it step by step. What each batch
read and dropped is in the journal (:mod:`mercato.streaming.journal`).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mercato.streaming.events import latest_per_key, windowed_metrics
from mercato.streaming.journal import BatchJournal
from mercato.streaming.sinks import Sink, console_sink, fan_out, folder_sink


def read_record_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON-line record files as a streaming frame with a
    ``value`` column, the shape a Kafka source gives (S9 stand-in, T15
    replay of dumped records). Files are taken oldest first; the event-time
    watermark then sees them in arrival order, so a dump should be written
    in event-time order (or with a watermark wider than its disorder).
    ``max_files_per_trigger`` bounds one micro-batch after a backlog."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true").option("latestFirst", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def arrival_number(folder: str = "chunk") -> Column:
    """The N of the folder ``<folder>=N`` a record file lies in: an arrival label that travels with the rows."""
    return F.regexp_extract(F.col("_metadata.file_path"), rf"{folder}=(\d+)", 1).cast("int")


def metrics_stream(
    events: DataFrame,
    time_col: str = "timestamp",
    code_col: str = "response_code",
    latency_col: str = "response_time_ms",
    watermark: str = "30 seconds",
    size: str = "10 seconds",
    slide: str | None = "5 seconds",
    arrival_col: str | None = None,
) -> DataFrame:
    """Watermarked windowed metrics (T2, T3, T5). Rows older than the
    watermark are dropped by Spark and their window state is evicted once
    the watermark passes the window end."""
    return windowed_metrics(
        events.withWatermark(time_col, watermark), time_col, code_col, latency_col, size, slide, arrival_col
    )


def batch_writer(
    out_path: str,
    fmt: str = "csv",
    console: bool = False,
    extra: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of one file output (T6, K12, K13, F8), with the console and one more function if asked.

    Nothing is remembered between batches; :func:`start_metrics_query` takes
    sinks with tokens."""
    sinks = [console_sink()] if console else []
    sinks.append(folder_sink(out_path, fmt))
    if extra is not None:
        sinks.append(Sink("extra", extra))
    return fan_out(sinks, None)


def start_metrics_query(
    metrics: DataFrame,
    out_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    fmt: str = "csv",
    console: bool = False,
    output_mode: str = "update",
    query_name: str | None = None,
    state_partitions: int | None = None,
    sinks: Sequence[Sink] = (),
) -> StreamingQuery:
    """Start the checkpointed query (T10, T11, T12). ``trigger`` defaults to
    a 15-second processing-time trigger; ``{"availableNow": True}`` takes what is there and ends.
    Besides the files at ``out_path`` (and the console) each batch goes once to every one of ``sinks``.

    ``state_partitions`` sets the shuffle/state-store partition count of the
    query. The window state holds (watermark + window) / slide windows per
    code, independent of the total volume, so a small fixed number fits any
    scale (the reference used 4). It is applied only while the query starts
    (the query keeps a copy of the session conf, and the first run writes
    the count into the checkpoint); the session value is restored."""
    outputs = [folder_sink(out_path, fmt), *([console_sink()] if console else []), *sinks]
    trig = trigger or {"processingTime": "15 seconds"}
    writer = (
        metrics.writeStream.outputMode(output_mode)
        .foreachBatch(fan_out(outputs, f"{checkpoint.rstrip('/')}_sinks"))
        .option("checkpointLocation", checkpoint)
        .trigger(**trig)
    )
    if query_name:
        writer = writer.queryName(query_name)
    if state_partitions is None:
        return writer.start()
    spark = metrics.sparkSession
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)


def await_or_stop(query: StreamingQuery, timeout_s: float | None = None, journal: BatchJournal | None = None) -> None:
    """Block until the query ends or the timeout passes, always stopping it.

    A timeout raises: what was written so far is not the whole stream. The
    ``journal`` is written out while the query runs, and closed."""
    limit = None if timeout_s is None else time.monotonic() + timeout_s
    ended = False
    try:
        while not ended and (limit is None or time.monotonic() < limit):
            ended = query.awaitTermination(10 if limit is None else max(0.1, min(10, limit - time.monotonic())))
            if journal is not None:
                journal.flush()
    finally:
        query.stop()
        if journal is not None:
            journal.close(query)
    if not ended:
        raise TimeoutError(f"the stream had not ended after {timeout_s} seconds")


def update_schema(metrics: DataFrame) -> T.StructType:
    """Schema of the written update rows: the metrics plus ``batch_id``."""
    return T.StructType(list(metrics.schema.fields) + [T.StructField("batch_id", T.LongType())])


def read_updates(spark: SparkSession, out_path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """All update rows written so far, with their ``batch_id``."""
    reader = spark.read.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.load(out_path)


def compact_updates(spark: SparkSession, out_path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Latest row per (window, code) across update batches."""
    return latest_per_key(read_updates(spark, out_path, schema, fmt))
