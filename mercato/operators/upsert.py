"""Keyed upsert (K6, K10): ``INSERT ... ON DUPLICATE KEY UPDATE``.

New keys are inserted whole; for a key already stored only the listed
update columns (the reference: ``revenue`` and ``loaded_at``) take the
incoming value, every other stored column is kept.

Spark has no in-place update of parquet tables (``MERGE INTO`` needs a
table format that supports it), so the merge is a full outer join on the
key producing the next version of the table; :func:`upsert_table` writes
that version beside the current one and only then publishes it, so the
path being read is never overwritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast/select ``df`` to a target schema by name (K10: the loader's
    type coercion); missing columns become nulls of the target type."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: Sequence[str],
    update_cols: Sequence[str],
    now: Column | None = None,
    stamp_col: str | None = "loaded_at",
) -> DataFrame:
    """The merged table: target ⊕ updates on ``key`` (K6).

    Both inputs are unique on ``key``. Rows are matched by a full outer
    join (one shuffle of each side on the key, sort-merge at scale);
    ``stamp_col`` gets ``now`` on inserted and updated rows.
    """
    key = list(key)
    updates = conform(updates, target.schema)
    t = target.select(*[F.col(c).alias(f"t__{c}") for c in target.columns], F.lit(True).alias("t__hit"))
    u = updates.select(*[F.col(c).alias(f"u__{c}") for c in updates.columns], F.lit(True).alias("u__hit"))
    cond = None
    for k in key:
        c = F.col(f"t__{k}") == F.col(f"u__{k}")
        cond = c if cond is None else cond & c
    joined = t.hint("merge").join(u, cond, "full_outer")
    matched_t = F.col("t__hit").isNotNull()
    matched_u = F.col("u__hit").isNotNull()
    stamp = now if now is not None else F.current_timestamp()
    out = []
    for f in target.schema.fields:
        c = f.name
        if c == stamp_col:
            value = F.when(matched_u, stamp.cast(f.dataType)).otherwise(F.col(f"t__{c}"))
        elif c in key:
            value = F.coalesce(F.col(f"t__{c}"), F.col(f"u__{c}"))
        elif c in update_cols:
            value = F.when(matched_u, F.col(f"u__{c}")).otherwise(F.col(f"t__{c}"))
        else:
            value = F.when(matched_t, F.col(f"t__{c}")).otherwise(F.col(f"u__{c}"))
        out.append(value.cast(f.dataType).alias(c))
    return joined.select(*out)


# -- versioned table on storage -------------------------------------------------
#
# <base>/version=<n>/   one complete copy of the table per published version
# <base>/versions_log/  append-only rows (version, published_at); a version is
#                       visible once its row is there, which is written only
#                       after the data write of that version has committed


def _latest(spark: SparkSession, base: str) -> int:
    """The last published version; 0 if none is.

    Only a log that is not there means an empty table. A log that cannot be
    read is an error: starting over would write over published data."""
    from pyspark.errors import AnalysisException

    try:
        log = spark.read.parquet(f"{base.rstrip('/')}/versions_log")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
    return log.agg(F.max("version")).first()[0] or 0


def read_current(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame | None:
    """The latest published version of a versioned table, or None."""
    version = _latest(spark, base)
    return spark.read.format(fmt).load(f"{base.rstrip('/')}/version={version}") if version else None


def upsert_table(
    spark: SparkSession,
    base: str,
    updates: DataFrame,
    key: Sequence[str],
    update_cols: Sequence[str],
    now: Column | None = None,
    fmt: str = "parquet",
) -> int:
    """Merge ``updates`` into the table at ``base`` and publish a new version.

    The new version is written to its own folder (never over the folder
    being read); it is published by appending its row to the versions log
    afterwards, so readers see the old or the new table, never a partial
    one, and a failed write leaves only an unpublished folder. Returns the
    published version number."""
    current = read_current(spark, base, fmt)
    merged = updates if current is None else upsert(current, updates, key, update_cols, now)
    nxt = _latest(spark, base) + 1
    root = base.rstrip("/")
    merged.write.mode("overwrite").format(fmt).save(f"{root}/version={nxt}")
    spark.createDataFrame([(nxt,)], "version int").withColumn("published_at", F.current_timestamp()).write.mode(
        "append"
    ).parquet(f"{root}/versions_log")
    return nxt
