"""SparkSession construction and session-level helpers.

The builder only sets what a job needs to be deterministic and
scale-aware: UTC session time, adaptive query execution (runtime
partition coalescing, skew-join splitting and broadcast conversion from
measured shuffle sizes), and no web UI. Anything the cluster already
configured (notably ``spark.checkpoint.dir``) is respected.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster reading ~100 TB (pass as ``extra_conf`` or put
# in the cluster's defaults). Scans split at 256 MB; shuffles start wide and
# AQE coalesces them to ~256 MB partitions and splits skewed join
# partitions; dimensions are broadcast only below a measured 64 MB; a
# leaving executor hands its shuffle blocks to others instead of forcing
# the recompute of whole stages.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "50000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.task.maxFailures": "8",
}


def build_session(
    master: str | None = None,
    app_name: str = "mercato",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the engine defaults.

    ``master`` and ``shuffle_partitions`` are left to the cluster when not
    given. On a cluster ``spark.sql.shuffle.partitions`` should be sized so
    one post-shuffle partition is ~128-256 MB at the target scale; AQE then
    coalesces small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra_conf:
        conf.update(extra_conf)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; it is used
    as is. Otherwise a checkpoint directory already set on the SparkContext
    is used. Only a local master (tests) gets a fresh local folder: on a
    cluster every executor would write to its own disk, so a missing
    setting is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect client has no SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster") from None
        return configured
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="mercato-ckpt-"))
    return sc.getCheckpointDir()


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables.

    Intermediate tables live next to the checkpoints (a folder every
    executor can reach), never in a machine-local temp folder. Every path
    handed out is recorded (:func:`scratch_paths`): frames returned by the
    operators read these tables lazily, so they are removed by the caller
    once the results are written (:func:`scratch_scope`), never by the
    operator itself."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def scratch_paths() -> list[str]:
    """The intermediate-table paths created in this process, oldest first."""
    return list(_SCRATCH)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables that were made inside the block.

    A job writes its outputs inside the block; frames that leave it must
    read those outputs, not the intermediate tables."""
    before = len(_SCRATCH)
    try:
        yield
    finally:
        own = _SCRATCH[before:]
        del _SCRATCH[before:]
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in own:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def materialize(df, spark: SparkSession, name: str, fmt: str = "parquet"):
    """Write ``df`` once to a fresh folder under the shared checkpoint
    directory and return the read-back frame: downstream plans scan the
    written table instead of recomputing its lineage, and a lost executor
    only costs re-reading files."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)
