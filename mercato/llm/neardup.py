"""Near-duplicate documents by b-bit MinHash.

1. Documents with equal word sequences form one class; everything below
   works on classes (rows of a class are counted once, however many copies).
2. Each class gets ``HASHES`` minima over its 5-word shingles. Of each
   minimum only the low ``BITS`` bits are kept, packed into one signature of
   128 bytes; the first minima also give band keys of ``ROWS`` minima each.
3. Classes that share a band key are candidates. Inside a bucket the
   similarity is estimated from the signatures by bit counts, corrected for
   chance agreement of the kept bits. A maximum spanning forest of the
   estimates gives as many candidate pairs as the bucket has members.
4. Candidate pairs are confirmed on full shingle sets; connected components
   of the confirmed links are formed by joins.
5. Pairs of one bucket whose classes are still in different components and
   whose estimate does not rule a link out are confirmed as well. So the
   components are those of all links, without listing the pairs inside them.

Two classes are linked at a Jaccard similarity of ``LINK_PERCENT``; the
pipeline stage links from ``STAGE_PERCENT`` on. The number of bands and the
estimate that rules a link out follow from the percentage (``Link``).

A bucket of more than ``BLOCK`` classes is compared block against block,
each pair of blocks in a group of its own, so no task holds more than two
blocks. Two classes at the threshold share none of the bands with
probability below 1e-5, and a link is estimated below the cut with
probability below 1e-4.

Null texts and texts without words belong to no class: 0 shingles, a
component of their own, kept. Rows with a null id take part in links but
name no component. Rows that repeat an id and text get the same answer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.frames import typed
from mercato.llm.graph import components
from mercato.llm.words import Words, mix, prefix_sums, range_hash, text_chunks, to_int64
from mercato.session import materialize

SHINGLE = 5
LINK_PERCENT = 85  # 100 * |A & B| >= 85 * |A | B|
STAGE_PERCENT = 80  # of the pipeline stage
HASHES, BITS = 512, 2
ROWS = 4  # minima of a band
MISS = 1e-5  # share of pairs at the threshold that may share no band
BLOCK = 2048
CHANCE = 2.0**-BITS  # two different minima agree in their low bits


class Link:
    """What follows from a link percentage: bands, and the agreements and sizes that a link needs."""

    def __init__(self, percent: int):
        j = percent / 100
        p = CHANCE + (1 - CHANCE) * j
        self.percent = percent
        self.bands = int(np.ceil(np.log(MISS) / np.log(1 - j**ROWS)))
        #: estimates of linked pairs lie above this but for four standard deviations
        self.cut = j - 4 * (p * (1 - p) / HASHES) ** 0.5 / (1 - CHANCE)
        self.agree = int(np.ceil(HASHES * (CHANCE + (1 - CHANCE) * self.cut)))


_AGREE = Link(LINK_PERCENT).agree

_SEEDS = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_MULTIPLY = (_SEEDS[:HASHES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_ADD = (_SEEDS[HASHES:] >> np.uint64(32)).astype(np.uint32)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text (empty without words)."""
    words = Words(buf, offsets, lower=True)
    sums, first = prefix_sums(words.hash), words.first
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = max(hi - lo - SHINGLE + 1, 1 if hi > lo else 0)
        at = lo + np.arange(n)
        yield np.unique(range_hash(sums, at, np.minimum(at + SHINGLE, hi)))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The ``HASHES`` minima of a non-empty shingle set."""
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(x), 512):
        np.minimum(out, (x[None, lo : lo + 512] * _MULTIPLY[:, None] + _ADD[:, None]).min(axis=1), out=out)
    return out


def low_bits(m: np.ndarray) -> np.ndarray:
    """``BITS`` bits of each minimum, packed 32 to a 64-bit word."""
    b = ((m * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint64).reshape(-1, 64 // BITS)
    return np.bitwise_or.reduce(b << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)), axis=1)


def band_keys(m: np.ndarray, bands: int) -> np.ndarray:
    rows = m[: bands * ROWS].astype(np.uint64).reshape(bands, ROWS)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(ROWS):
        key = mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + rows[:, r])
    return key


def band_tags(keys: np.ndarray) -> bytes:
    """Half of each band key, to tell in a bucket which other bands two classes share."""
    return (keys >> np.uint64(32)).astype(np.uint32).tobytes()


def agreements(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """How many of the minima's kept bits agree between a signature and others."""
    x = one ^ many
    for s in range(1, BITS):
        x = x | (x >> np.uint64(s))
    mask = np.uint64(sum(1 << (i * BITS) for i in range(64 // BITS)))
    return HASHES - np.bitwise_count(x & mask).sum(axis=-1).astype(np.int64)


def estimate(agree: np.ndarray) -> np.ndarray:
    """Jaccard similarity from agreeing bits, corrected for chance agreement."""
    return np.clip((agree / HASHES - CHANCE) / (1 - CHANCE), 0, 1)


def class_key(text: bytes) -> bytes | None:
    words = text.lower().split()  # both ASCII only on bytes
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


#: sig: the packed bits and the band tags
FEATURE_SCHEMA = "doc_id long, node binary, n_shingles long, sig binary, bands array<long>"
_SIG_BYTES = HASHES * BITS // 8


def signatures(docs: DataFrame, link: Link) -> DataFrame:
    """Per row: its class, set size, packed signature and band keys (null without words)."""
    schema = typed(FEATURE_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in text_chunks(batch.column(1)):
                data, at = buf.tobytes(), offsets.tolist()
                nodes, sizes, sigs, bands = [], [], [], []
                for i, s in enumerate(shingle_sets(buf, offsets)):
                    nodes.append(class_key(data[at[i] : at[i + 1]]))
                    sizes.append(len(s))
                    m = minima(s) if len(s) else None
                    keys = None if m is None else band_keys(m, link.bands)
                    sigs.append(None if m is None else low_bits(m).tobytes() + band_tags(keys))
                    bands.append(None if m is None else to_int64(keys))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(nodes, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.array(sigs, pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=schema.fieldNames(),
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def with_class(docs: DataFrame) -> DataFrame:
    """``docs`` as a struct ``__row``, their ``text`` and their class ``node``."""
    packed = docs.select(F.struct(*docs.columns).alias("__row"), F.col("text").cast("string").alias("text"))
    schema = typed(f"__row {packed.schema['__row'].dataType.simpleString()}, text string, node binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for _, _, buf, offsets in text_chunks(batch.column(1)):
                data, at = buf.tobytes(), offsets.tolist()
                keys += [class_key(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=schema.fieldNames())

    return packed.mapInArrow(run, schema)


class Bucket:
    """The classes of one bucket of a band (or of two blocks of it)."""

    def __init__(self, link: Link, nodes: list[bytes], sigs: np.ndarray, sizes: np.ndarray, comps: list[bytes], band: int, blocks: np.ndarray):
        self.link = link
        self.nodes, self.sizes, self.band, self.blocks = nodes, sizes, band, blocks
        self.sigs = np.ascontiguousarray(sigs[:, :_SIG_BYTES]).view(np.uint64)
        self.tags = np.ascontiguousarray(sigs[:, _SIG_BYTES:]).view(np.uint32)
        self.comps = np.unique(np.array(comps, object), return_inverse=True)[1] if comps else np.arange(len(nodes))

    def _possible(self, i: int) -> np.ndarray:
        """Agreements of class i with all, -1 where a link is ruled out."""
        agree = agreements(self.sigs[i], self.sigs)
        small, large = np.minimum(self.sizes[i], self.sizes), np.maximum(self.sizes[i], self.sizes)
        agree[(agree < self.link.agree) | (100 * small < self.link.percent * large)] = -1
        return agree

    def forest(self) -> Iterator[tuple[int, int]]:
        """Maximum spanning forest of the possible links (Prim)."""
        n = len(self.nodes)
        best, parent, out = np.full(n, -1), np.zeros(n, int), np.zeros(n, bool)
        i = 0
        for _ in range(n):
            out[i] = True
            agree = self._possible(i)
            better = (agree > best) & ~out
            best[better], parent[better] = agree[better], i
            best[out] = -2
            i = int(best.argmax())
            if best[i] >= 0:
                yield int(parent[i]), i

    def across(self) -> Iterator[tuple[int, int]]:
        """The possible links between different components that no earlier band and no other block pair has."""
        two = len(np.unique(self.blocks)) > 1
        for i in range(len(self.nodes) - 1):
            j = i + 1 + np.flatnonzero((self._possible(i)[i + 1 :] >= 0) & (self.comps[i + 1 :] != self.comps[i]))
            if two:
                j = j[self.blocks[j] != self.blocks[i]]
            if len(j):
                earlier = (self.tags[j, : self.band] == self.tags[i, : self.band]).any(axis=1)
                yield from ((i, int(k)) for k in j[~earlier])


def bucket_pairs(members: DataFrame, link: Link, pairs: Callable[[Bucket], Iterator[tuple[int, int]]]) -> DataFrame:
    """Distinct candidate pairs ``a < b`` of the buckets ``gid``."""
    schema = typed("a binary, b binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if tail is None else [tail, batch]).combine_chunks()
            rows = table.to_batches()[0] if table.num_rows else None
            if rows is None:
                continue
            gid = rows.column(0).to_numpy()
            last = int(np.searchsorted(gid, gid[-1])) if (np.diff(gid) >= 0).all() else 0
            yield from emit(rows.slice(0, last))
            tail = rows.slice(last)
        if tail is not None:
            yield from emit(tail)

    def emit(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        gid = rows.column(0).to_numpy()
        sigs = np.frombuffer(b"".join(rows.column(2).to_pylist()), np.uint8).reshape(rows.num_rows, -1)
        nodes, sizes, comps = rows.column(1).to_pylist(), rows.column(3).to_numpy(), rows.column(4).to_pylist()
        band, block = rows.column(5).to_numpy(), rows.column(6).to_numpy()
        start = np.flatnonzero(np.append(True, gid[1:] != gid[:-1]))
        end = np.append(start[1:], len(gid))
        a, b = [], []
        for lo, hi in zip(start.tolist(), end.tolist(), strict=True):
            if hi - lo > 1:
                bucket = Bucket(link, nodes[lo:hi], sigs[lo:hi], sizes[lo:hi], comps[lo:hi], int(band[lo]), block[lo:hi])
                for i, j in pairs(bucket):
                    x, y = sorted((nodes[lo + i], nodes[lo + j]))
                    if x != y:
                        a.append(x)
                        b.append(y)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    grouped = members.select("gid", "node", "sig", "n_shingles", "comp", "band", "own").repartition("gid")
    return grouped.sortWithinPartitions("gid", "node").mapInArrow(run, schema).distinct()


def confirmed(spark: SparkSession, pairs: DataFrame, texts: DataFrame, link: Link) -> DataFrame:
    """The pairs that are links on their full shingle sets; ``texts``: (node, text)."""
    schema = typed("a binary, b binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, own = None, None
        for batch in batches:
            a, keep = batch.column(0).to_pylist(), np.zeros(batch.num_rows, bool)
            for lo, _, buf, offsets in text_chunks(batch.column(3)):
                for i, other in enumerate(shingle_sets(buf, offsets), lo):
                    if a[i] != name:  # rows come sorted by a: its set is made once
                        name = a[i]
                        own = next(iter(_sets_of(batch.column(2).slice(i, 1))))
                    both = len(np.intersect1d(own, other, assume_unique=True))
                    keep[i] = 100 * both >= link.percent * (len(own) + len(other) - both)
            yield batch.select([0, 1]).filter(pa.array(keep))

    def _sets_of(column: pa.Array) -> Iterator[np.ndarray]:
        for _, _, buf, offsets in text_chunks(column):
            yield from shingle_sets(buf, offsets)

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return materialize(joined.mapInArrow(run, schema).distinct(), spark, "links")


def _texts(spark: SparkSession, docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(node, text)`` of the classes in ``pairs``, written once."""
    need = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    need = need.join(nodes.select("node", "rep"), "node").select(F.col("node").alias("need"), "rep")
    found = with_class(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = found.select(F.col("__row.doc_id").alias("doc_id"), "text", "node")
    found = found.join(need, (F.col("node") == F.col("need")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    return materialize(found.select("node", "text"), spark, "texts")


def classify(spark: SparkSession, docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Per row ``(doc_id, node, n_shingles)``, and per class ``(node, top, component_id)``.

    ``top`` is a class that stands for the component, ``component_id`` the
    smallest id in it (null where all are null)."""
    link = Link(percent)
    feats = materialize(signatures(docs, link), spark, "signatures")
    nodes = feats.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("rep"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("sig").alias("sig"),
        F.first("bands").alias("bands"),
    )
    nodes = materialize(nodes, spark, "classes")

    keys = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    members = materialize(keys.join(materialize(shared, spark, "shared_keys"), "key"), spark, "members")

    def blocks(rows: DataFrame) -> DataFrame:
        """One row per group that a member is compared in: (key, block, block)."""
        count = F.expr(f"(n + {BLOCK - 1}) div {BLOCK}")
        own = F.pmod(F.xxhash64("node"), count)
        rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
        gid = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
        sig = nodes.select("node", "sig", "n_shingles")
        return rows.select("node", gid.alias("gid"), "comp", "band", "own").join(sig, "node")

    first = materialize(
        bucket_pairs(blocks(members.withColumn("comp", F.col("node"))), link, lambda b: b.forest()), spark, "pairs"
    )
    links = confirmed(spark, first, _texts(spark, docs, nodes, first), link)
    roots = materialize(components(spark, links), spark, "roots")

    placed = members.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    placed = materialize(placed, spark, "members")
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    open_buckets = placed.join(materialize(mixed, spark, "mixed_keys"), "key")
    second = bucket_pairs(blocks(open_buckets), link, lambda b: b.across()).join(first, ["a", "b"], "left_anti")
    second = materialize(second, spark, "pairs")
    more = confirmed(spark, second, _texts(spark, docs, nodes, second), link)
    bridges = more
    for end in ("a", "b"):
        bridges = bridges.join(roots.withColumnRenamed("node", end), end, "left")
        bridges = bridges.withColumn(end, F.coalesce("root", end)).drop("root")
    merged = materialize(components(spark, bridges), spark, "roots").select(
        F.col("node").alias("root"), F.col("root").alias("top")
    )

    top = (
        nodes.select("node", "rep")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .join(merged, "root", "left")
        .select("node", "rep", F.coalesce("top", "root").alias("top"))
    )
    top = materialize(top, spark, "tops")
    ids = materialize(top.groupBy("top").agg(F.min("rep").alias("component_id")), spark, "component_ids")
    classes = materialize(top.join(ids, "top").select("node", "top", "component_id"), spark, "class_components")
    return feats.select("doc_id", "node", "n_shingles"), classes


def near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    rows, classes = classify(spark, docs, LINK_PERCENT)
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    kept = F.when(F.col("node").isNull(), True).otherwise(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    return rows.join(classes, "node", "left").select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def keep_one(spark: SparkSession, docs: DataFrame, percent: int = STAGE_PERCENT) -> DataFrame:
    """One row of each component, columns unchanged; rows without words stay.

    The row whose id names the component stays. Where that id and text come
    several times, one of these rows does; a component in which every id is
    null keeps one row of its smallest class."""
    rows, classes = classify(spark, docs, percent)
    chosen = rows.filter(F.col("node").isNotNull()).join(classes, "node")
    chosen = chosen.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    sizes = chosen.groupBy("top", "node", "doc_id").agg(F.count("*").alias("n"))
    first = sizes.groupBy("top").agg(F.min(F.struct("node", "n", "doc_id")).alias("s")).select("s.*")
    stay = materialize(first.select(F.col("node").alias("__node"), F.col("doc_id").alias("__id"), "n"), spark, "kept")
    found = (F.col("node") == F.col("__node")) & F.col("__row.doc_id").cast("long").eqNullSafe(F.col("__id"))
    joined = with_class(docs).join(stay, found, "left")
    out = joined.filter(F.col("node").isNull() | (F.col("n") == 1)).select("__row.*")
    if not stay.filter("n > 1").isEmpty():  # rows that repeat an id and text
        out = out.unionByName(joined.filter("n > 1").dropDuplicates(["node"]).select("__row.*"))
    return out
