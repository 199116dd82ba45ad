"""One micro-batch, several sinks, each batch delivered once to each.

``foreachBatch`` is at-least-once: after a failure the whole batch comes
again, also to sinks that had it. Every sink here has a token, an empty file
named after the last batch it finished, in a folder beside the checkpoint.
A batch that comes again is given only to the sinks that have not finished it,
so also a sink that cannot replace its own output (an appended table, a
console, a database) gets it once. A sink that fails after it wrote and before
its token is the one case left; sinks that replace a folder per batch are safe
there too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sink:
    name: str
    write: Callable[[DataFrame, int], None]


def folder_sink(path: str, fmt: str = "csv", name: str = "folders") -> Sink:
    """Each batch in its own ``batch_id=N`` folder, replaced if it comes again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.repartition(1)  # a row per changed window and code
        out.write.mode("overwrite").format(fmt).option("header", "true").save(f"{path.rstrip('/')}/batch_id={batch_id}")

    return Sink(name, write)


def append_sink(path: str, fmt: str = "parquet", name: str = "appended") -> Sink:
    """All batches appended to one table."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.repartition(1).write.mode("append").format(fmt).save(path)

    return Sink(name, write)


def console_sink(rows: int = 20, name: str = "console") -> Sink:
    """The first rows of each batch on standard output."""

    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(rows, truncate=False)

    return Sink(name, write)


class Tokens:
    """The last finished batch of each sink, as files under a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._folder = folder.rstrip("/")
        self._fs = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def last(self, sink: str) -> int:
        folder = self._path(f"{self._folder}/{sink}")
        if not self._fs.exists(folder):
            return -1
        return max((int(f.getPath().getName()) for f in self._fs.listStatus(folder)), default=-1)

    def finish(self, sink: str, batch_id: int) -> None:
        before = self.last(sink)
        self._fs.create(self._path(f"{self._folder}/{sink}/{batch_id}")).close()
        if 0 <= before < batch_id:
            self._fs.delete(self._path(f"{self._folder}/{sink}/{before}"), False)


def fan_out(sinks: Sequence[Sink], token_folder: str | None) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function over all ``sinks``.

    The batch is persisted and counted once at the full width of the state
    stage, so that stage runs once however many sinks follow; an empty batch
    reaches none. Rows carry their ``batch_id`` (P3)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tokens = None if token_folder is None else Tokens(batch.sparkSession, token_folder)
        open_sinks = [s for s in sinks if tokens is None or tokens.last(s.name) < batch_id]
        batch.persist()
        try:
            if not open_sinks or not batch.count():
                return
            tagged = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            for sink in open_sinks:
                sink.write(tagged, batch_id)
                if tokens is not None:
                    tokens.finish(sink.name, batch_id)
        finally:
            batch.unpersist()

    return write
