"""Deterministic surrogate keys 1..n in the order of natural-key columns.

``row_number() OVER (ORDER BY k)`` without a partition runs on one task.
Here the rows are range-partitioned on the order columns and sorted inside
each range bucket (one shuffle), a row's position in its bucket is read off
as it is written, and shifted by the prefix sum of the bucket sizes (one
row per bucket). The result equals the global row_number, for a lookup of
ten rows or a dimension of billions; keys are 64-bit. The numbered rows are
written once to the shared checkpoint folder, so both uses of them agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _range_buckets(df: DataFrame, buckets: int | None, cols):
    """Range-partition ``df`` on ``cols``: into ``buckets`` partitions when
    given, else as many as the session uses, coalescible by AQE."""
    if buckets is None:
        return df.repartitionByRange(*cols)
    return df.repartitionByRange(buckets, *cols)


def with_surrogate_key(
    df: DataFrame,
    order_by: Sequence[str],
    key_name: str,
    buckets: int | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``key_name`` = position (1-based) of the row when sorted by
    ``order_by``, restarting at 1 in every ``group_by`` group; the group and
    order columns together must identify a row."""
    spark = df.sparkSession
    group_by = list(group_by)
    # bucket ids are stored once (shared checkpoint folder) so the numbering
    # and the bucket sizes are computed from the same assignment
    from mercato.session import materialize

    keys = [*group_by, *order_by]
    ranged = materialize(
        _range_buckets(df, buckets, keys)
        .sortWithinPartitions(*keys)
        .withColumn("__bucket", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id()),  # rises along the sorted bucket
        spark,
        "surrogate-buckets",
    )
    sizes = ranged.groupBy(*group_by, "__bucket").agg(F.count(F.lit(1)).alias("__size"), F.min("__at").alias("__start"))
    before = Window.partitionBy(*group_by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *group_by, "__bucket", "__start", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset")
    )
    # one offset row per (group, bucket); a group spans consecutive buckets,
    # so there are at most buckets + groups - 1 rows. Without groups that is
    # bounded by the partition count and the side is broadcast.
    if not group_by:
        offsets = F.broadcast(offsets)
    return (
        ranged.join(offsets, [*group_by, "__bucket"])
        .withColumn(key_name, F.col("__offset") + F.col("__at") - F.col("__start") + 1)
        .drop("__bucket", "__at", "__start", "__offset")
    )


def lasting_keys(
    spark: SparkSession, path: str, names: DataFrame, name: str = "name", key_name: str = "id", group_by: Sequence[str] = ()
) -> DataFrame:
    """The key map ``(group..., key, name)`` stored at ``path``, after ``names`` were added to it (AUTO_INCREMENT).

    A name that has a key keeps it for good, whatever later loads bring; new
    names are numbered in their order after the greatest key of their group.
    Known names are left out by an anti join before they are numbered, so a
    load that brings nothing new numbers nothing, and a load that is repeated
    changes nothing. The map is append-only: one writer at a time."""
    group_by = list(group_by)
    fields = [*group_by, key_name, name]
    new = names.select(*group_by, name).filter(F.col(name).isNotNull()).distinct()
    try:
        known = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        known = None
    if known is not None:
        same = reduce(and_, [new[c].eqNullSafe(known[c]) for c in [*group_by, name]])
        new = new.join(known, same, "left_anti")
    numbered = with_surrogate_key(new, [name], key_name, group_by=group_by)
    if known is None:
        numbered.select(*fields).write.parquet(path)
        return spark.read.parquet(path)
    last = known.groupBy(*group_by).agg(F.max(key_name).alias("__last"))
    if group_by:
        renamed = last.select("__last", *[F.col(g).alias(f"__g_{g}") for g in group_by])
        numbered = numbered.join(renamed, reduce(and_, [F.col(g).eqNullSafe(F.col(f"__g_{g}")) for g in group_by]), "left")
    else:
        numbered = numbered.withColumn("__last", F.lit(last.first()["__last"]))
    numbered = numbered.withColumn(key_name, F.col(key_name) + F.coalesce("__last", F.lit(0)))
    numbered.select(*fields).write.mode("append").parquet(path)
    return spark.read.parquet(path)
