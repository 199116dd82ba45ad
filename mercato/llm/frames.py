"""Small DataFrame helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(ddl: str) -> T.StructType:
    """A schema from its DDL (needs no session)."""
    return T.StructType.fromDDL(ddl)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def running_base(counts: DataFrame, group: str) -> DataFrame:
    """``base`` = rows of the group in the tasks before ``pid``.

    ``counts`` has one row ``(pid, group, n)`` per task and group, so the
    window sorts as many rows per group as there are tasks, not rows."""
    before = Window.partitionBy(group).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("pid", group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
