"""Keyed loads that change only the partitions they touch (K6).

The table is stored by a hash of its key, ``<base>/bucket_of_<n>=<b>/``. A
load reads the partitions that its keys fall into (partition pruning), merges
them with the incoming rows and replaces just those (dynamic partition
overwrite); all other files stay as they are, under their names. A load of a
thousand rows costs as many partitions as it has hashes, not the table.

The merged partitions are first written whole to ``<base>/_pending`` and
swapped in from there. If the job dies while partitions are swapped, the next
load (or :func:`read_merged`) finishes the swap from that copy before it does
anything else; an unfinished copy is thrown away. One writer at a time: Spark
has no lock to offer over plain files.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators.upsert import conform, upsert
from mercato.sources.files import write_table

BUCKETS = 64
_BUCKET = re.compile(r"bucket_of_(\d+)")


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    folder, fs = _folder(spark, path)
    return fs.exists(folder)


def _remove(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def _bucket_column(columns: Sequence[str]) -> str:
    return next(c for c in columns if _BUCKET.fullmatch(c))


def _bucket(key: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")


def _swap(spark: SparkSession, base: str) -> None:
    """Put the partitions of a finished ``_pending`` copy in place; drop an unfinished one."""
    pending = f"{base}/_pending"
    if _exists(spark, f"{pending}/_SUCCESS"):
        rows = spark.read.parquet(pending)
        bucket = _bucket_column(rows.columns)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(bucket).parquet(f"{base}/rows")
    if _exists(spark, pending):
        _remove(spark, pending)


def _stored(spark: SparkSession, base: str) -> DataFrame | None:
    _swap(spark, base)
    return spark.read.parquet(f"{base}/rows") if _exists(spark, f"{base}/rows/_SUCCESS") else None


def read_merged(spark: SparkSession, base: str) -> DataFrame | None:
    """The table's rows, or None if nothing was loaded."""
    stored = _stored(spark, base.rstrip("/"))
    return None if stored is None else stored.drop(_bucket_column(stored.columns))


def merge_table(
    spark: SparkSession,
    base: str,
    updates: DataFrame,
    key: Sequence[str],
    update_cols: Sequence[str],
    now: Column | None = None,
    stamp_col: str | None = "loaded_at",
    buckets: int = BUCKETS,
) -> list[int]:
    """``INSERT ... ON DUPLICATE KEY UPDATE`` of ``updates`` into the table at ``base``.

    As :func:`mercato.operators.upsert.upsert`: new keys are inserted whole, of
    stored keys only ``update_cols`` and the stamp change. The first load
    fixes the schema and the number of ``buckets``; later loads are cast to it. Keys must be
    unique and not null within a load, else nothing is written. Returns the
    partitions that were replaced."""
    base, key = base.rstrip("/"), list(key)
    stored = _stored(spark, base)
    if stored is not None:
        column = _bucket_column(stored.columns)
        buckets = int(_BUCKET.fullmatch(column)[1])
        updates = conform(updates, stored.drop(column).schema)
    else:
        column = f"bucket_of_{buckets}"
    empty = F.lit(False)
    for k in key:
        empty |= F.col(k).isNull()
    per_key = updates.groupBy(*key).agg(F.count("*").alias("n")).withColumn(column, _bucket(key, buckets))
    # one job: what is wrong with the keys, and which partitions they fall into (at most `buckets` numbers)
    state = per_key.agg(F.count_if(empty).alias("nulls"), F.count_if(F.col("n") > 1).alias("repeated"), F.collect_set(column).alias("touched")).first()
    if state["nulls"] or state["repeated"]:
        raise ValueError(f"the load has {state['nulls']} null and {state['repeated']} repeated keys")
    touched = sorted(state["touched"])
    if not touched and stored is not None:
        return []
    if stored is None:
        if stamp_col in updates.columns and now is not None:
            updates = updates.withColumn(stamp_col, now.cast(updates.schema[stamp_col].dataType))
        write_table(updates.withColumn(column, _bucket(key, buckets)), f"{base}/rows", "parquet", partition_by=[column])
        return touched
    part = stored.filter(F.col(column).isin(touched)).drop(column)
    merged = upsert(part, updates, key, update_cols, now, stamp_col).withColumn(column, _bucket(key, buckets))
    write_table(merged, f"{base}/_pending", "parquet", partition_by=[column])
    _swap(spark, base)
    return touched
