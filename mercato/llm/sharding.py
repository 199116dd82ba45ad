"""Byte-balanced shards through fixed virtual slots and a versioned slot map.

Records are hashed into ``SLOTS`` virtual slots that never change. One
aggregate gives the bytes of each slot; a map says which shard holds a
slot. The first version of the map deals the slots out evenly by number;
rebalancing edits it: slots move from the heaviest to the lightest shard
until no move makes them more equal, and the edited map is stored as the
next version. Records are never ranked or moved one by one, only the map
is.

The map lives in a folder (``map_path``) with all its versions. A later call
loads the latest one, edits that and stores the result as the next version,
unless the loads are within ``SLACK`` of each other as they are. Records of
slots that were not edited stay where they were; more shards than before take
slots only by edits.

A slot that holds more than ``1 / HOT_PARTS`` of an average shard is divided
into ``PARTS`` parts by a second hash of the record plus the number of its
copy, so also the copies of one repeated row are spread; its parts move like
slots, and it stays divided in later versions. Slot and part follow from the
record and not from files, splits or tasks: reading the corpus again moves
nothing. At most ``shards * HOT_PARTS`` slots can be that large at a time, so
the map and all that reaches the driver are bounded by the parameters.

The law is ``bytes``: shard sizes are as near equal as whole slots allow.
Null texts have no bytes (size 8, checksum of nothing), null ids hash like
any other value, repeated rows are placed one by one, very long texts are one
record each, an empty table gives an empty result. Other columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.frames import running_base
from mercato.session import materialize, scratch_path

SHARDS = 24
SLOTS = 4096
PARTS = 64
HOT_PARTS = 16
ROW_BYTES = 8
SLACK = 0.01  # a stored map is edited if the heaviest and the lightest shard differ by more of the mean
WHOLE = -1  # the part number of an undivided slot

Unit = tuple[int, int]  # slot, part
SlotMap = dict[Unit, int]


def first_map(units: list[Unit], shards: int) -> SlotMap:
    """Version 1: slots dealt out by number, whatever they hold."""
    return {u: (u[0] + max(0, u[1])) % shards for u in units}


def rebalanced(current: SlotMap, sizes: dict[Unit, int], shards: int) -> SlotMap:
    """The next version: edits of ``current`` that even out the shards' bytes.

    Each edit moves the unit nearest to half the difference between the
    heaviest and the lightest shard, so their difference shrinks every time."""
    out, held, load = dict(current), [[] for _ in range(shards)], [0] * shards
    for unit, shard in current.items():
        load[shard] += sizes.get(unit, 0)
        held[shard].append((sizes.get(unit, 0), unit))
    for h in held:
        h.sort()
    light = [(b, s) for s, b in enumerate(load)]
    heapq.heapify(light)
    for heavy in sorted(range(shards), key=lambda s: -load[s]) * 64:  # passes end early once no move helps
        while True:
            while light[0][0] != load[light[0][1]]:
                heapq.heappop(light)  # a load that has changed since
            low = light[0][1]
            gap = load[heavy] - load[low]
            k = bisect_right(held[heavy], (gap // 2, (1 << 62, 0)))
            near = [held[heavy][i] for i in (k - 1, k) if 0 <= i < len(held[heavy]) and 0 < held[heavy][i][0] < gap]
            if not near:
                break
            size, unit = min(near, key=lambda x: (abs(gap - 2 * x[0]), x))
            held[heavy].remove((size, unit))
            insort(held[low], (size, unit))
            out[unit] = low
            for s, change in ((heavy, -size), (low, size)):
                load[s] += change
                heapq.heappush(light, (load[s], s))
    return out


def fitted(current: SlotMap, units: list[Unit], shards: int) -> SlotMap:
    """``current`` over other units: the parts of a newly divided slot start where it was."""
    out = {}
    for slot, part in units:
        shard = current.get((slot, part), current.get((slot, WHOLE), slot % shards))
        out[slot, part] = shard if shard < shards else slot % shards
    return out


def spread(current: SlotMap, sizes: dict[Unit, int], shards: int) -> float:
    """The difference between the heaviest and the lightest shard as a share of the mean."""
    load = [0] * shards
    for unit, shard in current.items():
        load[shard] += sizes.get(unit, 0)
    return (max(load) - min(load)) * shards / max(1, sum(load))


def next_map(stored: SlotMap | None, sizes: dict[Unit, int], units: list[Unit], shards: int) -> list[SlotMap]:
    """The versions to be added: two for a new map, at most one to a stored one."""
    if stored is None:
        start = first_map(units, shards)
        return [start, rebalanced(start, sizes, shards)]
    kept = fitted(stored, units, shards)
    if spread(kept, sizes, shards) > SLACK:
        kept = rebalanced(kept, sizes, shards)
    return [] if kept == stored else [kept]


def latest_map(spark: SparkSession, map_path: str) -> tuple[int, SlotMap | None]:
    """The number and content of the last stored version; 0 and None where there is none."""
    try:
        table = spark.read.parquet(map_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, None
    last = table.agg(F.max("map_version")).first()[0]
    rows = table.filter(F.col("map_version") == last).collect()  # bounded by the numbers of slots and parts
    return last, {(r["virtual_slot"], r["part"]): r["shard"] for r in rows}


def with_parts(records: DataFrame, shards: int, divided: set[int]) -> tuple[DataFrame, dict[Unit, int]]:
    """Records with their unit (``virtual_slot, part``), and the bytes of each unit; ``divided`` slots stay divided."""
    spark = records.sparkSession
    # at most SLOTS rows
    slots = {r[0]: r[1] for r in records.groupBy("virtual_slot").agg(F.sum("size")).collect()}
    limit = sum(slots.values()) / (shards * HOT_PARTS)
    hot = sorted(divided | {s for s, b in slots.items() if b > limit})
    sizes: dict[Unit, int] = {(s, WHOLE): slots.get(s, 0) for s in range(SLOTS) if s not in set(hot)}
    if not hot:
        return records.withColumn("part", F.lit(WHOLE)), sizes
    inside = F.col("virtual_slot").isin(hot)
    rows = records.filter(inside)
    counts = materialize(rows.groupBy("pid", "key").agg(F.count("*").alias("n")), spark, "shard_copies")
    copy = F.row_number().over(Window.partitionBy("pid", "key").orderBy("place")) - 1 + F.col("base")
    rows = rows.join(running_base(counts, "key"), ["pid", "key"]).withColumn("copy", copy)
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "key") + F.col("copy"), F.lit(PARTS)).cast("int"))
    rest = records.filter(~inside).withColumn("part", F.lit(WHOLE))
    units = materialize(rest.unionByName(rows.select(*rest.columns)), spark, "shard_units")
    # at most PARTS rows per divided slot
    found = units.filter(inside).groupBy("virtual_slot", "part").agg(F.sum("size").alias("b")).collect()
    sizes |= {(s, p): 0 for s in hot for p in range(PARTS)} | {(r["virtual_slot"], r["part"]): r["b"] for r in found}
    return units, sizes


def assign(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, map_path: str | None = None) -> DataFrame:
    """Every row's shard and its place there.

    ``doc_id, size, text_crc32, law, shard, slot`` (the row's place in its
    shard, gapless from 0), ``grown_shard`` (null under this law),
    ``virtual_slot`` and ``map_version``. The slot map at ``map_path`` is
    loaded, edited and stored; without a path a new map is made."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    records = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col("doc_id").cast("long"), text).alias("key"),
        F.spark_partition_id().alias("pid"),
        F.monotonically_increasing_id().alias("place"),
    ).withColumn("virtual_slot", F.pmod("key", F.lit(SLOTS)).cast("int"))
    path = map_path or scratch_path(spark, "slot_map")
    last, stored = latest_map(spark, path)
    divided = {s for s, part in stored or {} if part != WHOLE}
    records, sizes = with_parts(materialize(records, spark, "records"), shards, divided)
    versions = next_map(stored, sizes, sorted(sizes), shards)
    if versions:
        store_map(spark, path, versions, last + 1)
    # the map is bounded by the numbers of slots and parts
    now = spark.read.parquet(path).filter(F.col("map_version") == last + len(versions))
    placed = records.join(F.broadcast(now), ["virtual_slot", "part"])
    counts = materialize(placed.groupBy("pid", "shard").agg(F.count("*").alias("n")), spark, "shard_counts")
    rank = F.row_number().over(Window.partitionBy("pid", "shard").orderBy("place")) - 1
    return (
        placed.withColumn("rank", rank)
        .join(running_base(counts, "shard"), ["pid", "shard"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("base") + F.col("rank")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
            "map_version",
        )
    )


def store_map(spark: SparkSession, map_path: str, versions: list[SlotMap], first: int) -> None:
    """Append versions, each whole, so any can be read alone."""
    rows = [(v, s, p, shard) for v, m in enumerate(versions, first) for (s, p), shard in sorted(m.items())]
    table = spark.createDataFrame(rows, "map_version int, virtual_slot int, part int, shard int")
    table.coalesce(1).write.mode("append").parquet(map_path)
