"""Late events with a side output (T5).

Spark drops a row from every window that the watermark has closed and leaves
only a number. This query applies the same rule to the same records and
keeps the rows: an event that has missed at least one of its windows is written with
the number it missed and the number it still reached. It is stateless but for
one value, the latest event time up to each batch, which is stored with the
batch: a batch that comes again finds the watermark it had before and
replaces its own output.

The rule as Spark applies it: batch N's watermark is the latest event time of the
batches before it less the delay, in whole milliseconds; a window whose end is
not after it is closed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _micros(interval: str) -> Column:
    start = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
    return F.expr(f"timestampdiff(MICROSECOND, {start}, {start} + INTERVAL {interval})")


def missed_windows(time: Column, watermark: Column, size: str, slide: str | None) -> tuple[Column, Column]:
    """(closed, open): how many windows of an event the watermark (in microseconds, null: none yet) has closed or not."""
    length, step = _micros(size), _micros(slide or size)
    at = F.unix_micros(time)
    newest = at - F.pmod(at, step)
    count = F.ceil(length / step).cast("int")
    ends = F.transform(F.sequence(F.lit(0), count - 1), lambda i: newest - i * step + length)
    ends = F.filter(ends, lambda e: e > at)
    closed = F.size(F.filter(ends, lambda e: F.coalesce(e <= watermark, F.lit(False))))
    return closed, F.size(ends) - closed


def _latest(spark: SparkSession, folder: str, batch_id: int) -> int | None:
    """The latest event time, in microseconds, of all batches before ``batch_id``."""
    if batch_id == 0:
        return None
    return spark.read.parquet(f"{folder}/batch_id={batch_id - 1}").first()["latest"]


def start_late_router(
    events: DataFrame,
    out_path: str,
    checkpoint: str,
    time_col: str = "timestamp",
    delay: str = "30 seconds",
    size: str = "10 seconds",
    slide: str | None = "5 seconds",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the checkpointed query that writes late events to ``out_path``, a folder per batch.

    ``events`` are parsed events with a time (:func:`mercato.streaming.events.parse_events`),
    without a watermark of their own."""
    state = f"{checkpoint.rstrip('/')}_latest"

    def route(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _latest(spark, state, batch_id)
        watermark = F.lit(before).cast("long")
        watermark = (F.call_function("div", watermark, F.lit(1000)) * 1000 - _micros(delay)).cast("long")
        closed, left = missed_windows(F.col(time_col), watermark, size, slide)
        seen = Observation()
        rows = batch.observe(seen, F.max(F.unix_micros(time_col)).alias("latest"))  # one scan serves both
        late = rows.select("*", closed.alias("closed_windows"), left.alias("open_windows")).filter(F.col("closed_windows") > 0)
        late.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")
        now = seen.get["latest"]
        latest = max((x for x in (before, now) if x is not None), default=None)
        spark.createDataFrame([(latest,)], "latest long").write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")

    writer = events.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "15 seconds"})).start()


def read_late(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path)
