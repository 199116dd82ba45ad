"""Incremental compaction of update rows.

An update-mode query writes a (window, code) again in every batch that touches
it. Folding all batches at each read costs the whole history. Here a step
folds the previous step's open windows with the batches that came since, and
writes them with a mark: windows that the watermark has closed cannot change
and are never read by a step again; the others are the next step's input. A
step therefore reads the open windows and the new batches, however long the
stream has run.

A step is the folder ``upto=<batch>`` with partitions ``state=closed`` and
``state=open``; it counts once its write has committed, and a step that is run again
replaces itself. Batches of the update output that a step covers may be removed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.streaming.events import latest_per_key


def _numbered(spark: SparkSession, base: str, name: str) -> list[int]:
    """N of the finished folders ``<name>=N`` under ``base`` (names only, no data)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path(base)):
        return []
    found = [re.fullmatch(rf"{name}=(\d+)", s.getPath().getName()) for s in fs.listStatus(path(base))]
    return sorted(int(m[1]) for m in found if m and fs.exists(path(f"{base}/{m[0]}/_SUCCESS")))


def _tail(spark: SparkSession, updates: str, schema: T.StructType, after: int, fmt: str) -> tuple[DataFrame | None, int]:
    batches = [b for b in _numbered(spark, updates, "batch_id") if b > after]
    if not batches:
        return None, after
    reader = spark.read.format(fmt).schema(schema).option("header", "true")
    return reader.load([f"{updates}/batch_id={b}" for b in batches]), batches[-1]


def _state(spark: SparkSession, base: str, steps: list[int], state: str, schema: T.StructType) -> DataFrame:
    kept = T.StructType([*schema.fields, T.StructField("state", T.StringType())])
    if not steps:
        return spark.createDataFrame([], schema)
    frames = spark.read.schema(kept).option("basePath", base)
    return frames.parquet(*[f"{base}/upto={s}" for s in steps]).filter(F.col("state") == state).select(*schema.fieldNames())


def compact_step(
    spark: SparkSession, updates: str, schema: T.StructType, base: str, closed_before: str | None, fmt: str = "csv"
) -> int | None:
    """Fold the batches since the last step; the batch it reaches, or None if there is nothing new.

    ``closed_before`` is a watermark of a batch that the step covers, or an earlier one
    (:func:`mercato.streaming.journal.last_watermark`): windows that end by
    then are closed."""
    updates, base = updates.rstrip("/"), base.rstrip("/")
    steps = _numbered(spark, base, "upto")
    tail, upto = _tail(spark, updates, schema, steps[-1] if steps else -1, fmt)
    if tail is None:
        return None
    rows = latest_per_key(_state(spark, base, steps[-1:], "open", schema).unionByName(tail))
    closed = F.coalesce(F.col("window_end") <= F.to_timestamp(F.lit(closed_before)), F.lit(False))
    rows = rows.withColumn("state", F.when(closed, F.lit("closed")).otherwise(F.lit("open")))
    rows.write.mode("overwrite").partitionBy("state").parquet(f"{base}/upto={upto}")
    return upto


def read_compacted(spark: SparkSession, updates: str, schema: T.StructType, base: str, fmt: str = "csv") -> DataFrame:
    """The latest row of every (window, code): closed ones as stored, open ones with the batches since the last step."""
    updates, base = updates.rstrip("/"), base.rstrip("/")
    steps = _numbered(spark, base, "upto")
    tail, _ = _tail(spark, updates, schema, steps[-1] if steps else -1, fmt)
    rows = _state(spark, base, steps[-1:], "open", schema)
    if tail is not None:
        rows = latest_per_key(rows.unionByName(tail)).select(*schema.fieldNames())
    return _state(spark, base, steps, "closed", schema).unionByName(rows)
