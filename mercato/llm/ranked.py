"""Ranked lexical search: posting lists in geometric blocks with coordinatewise-maximum summaries.

A document's *gain* for a term is ``(10**9 * tf) div (1000 * tf + 20 * m)``
with ``m = 50 + (50 * n * N) div L``; its score for an item sums weight times
gain over the item's distinct terms. Items are taken in blocks of bounded
size, so that only one block's terms, weights and thresholds are in a task.
For each block:

1. One pass over the texts writes every document's vector: its length and
   the frequencies of the block's terms. ``N``, ``L`` and the document
   frequencies are sums over that table.
2. Documents are sorted by the signs of their weighted vectors under random
   hyperplanes: similar documents become neighbours. Every task holds a range
   of that order and cuts it into runs. A run's part of a posting list is
   therefore clustered by similarity; it is cut into blocks of ``BLOCK``
   documents, and each block keeps the coordinatewise maximum of its
   documents' gains (the coordinates are the terms that occur in an item
   together with the list's term). Runs are rows of a written table. No
   vector is copied for each of its terms, and a hot term's list is spread
   over all tasks.
3. Seeds: every run scores, for each item, the documents of the block with
   the highest bound, and gives the best of them (fewer, the more runs there
   are). The ``top``-th best seed score is a score that the result cannot
   fall below.
4. Search: lists whose terms cannot reach that score together are left out
   (their greatest gains in the run add up to less); of the other lists each
   block whose summary's score is lower is skipped. The documents of all other blocks are
   scored in full. Summaries are exact integers, so nothing is lost: a
   skipped document scores below ``top`` others.

A run's part of a list under ``LEAST`` documents has no summary and is always
read if its list is.

Null and empty texts have no terms; they rank nowhere. A very long text is
one vector like any other, a very long item is a block of its own. Every row of ``documents`` is a document and every
row of the items an item, also where ids repeat or are null; equal scores go
by ascending doc_id, null last. Empty tables give an empty result. Other
columns, whatever their names, are ignored. Terms are compared by 64-bit
hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.words import _BYTE_POWERS, _BYTES_LOWER, mix, prefix_sums, range_hash, text_chunks
from mercato.session import materialize, scratch_path

TOP = 50
BLOCK = 256  # documents of a block
LEAST = 64  # shorter parts of lists have no summary
RUN_POSTINGS = 1 << 18  # a run is closed beyond either
RUN_DOCS = 1 << 12
ITEMS = 1024  # an item block is closed beyond either
TERMS = 1 << 14
PLANES = 48
REMEMBERED = 1 << 22  # numbers that a task keeps for lists or scores at once

IS_TERM = np.zeros(256, bool)
IS_TERM[128:] = True
IS_TERM[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms_of(text: str | None) -> list[str]:
    """All terms of a text in order."""
    return _TERM.findall((text or "").translate(_LOWER))


def _hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of some texts, and each text's first place among them."""
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = IS_TERM[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    sums = prefix_sums(_BYTES_LOWER[buf], _BYTE_POWERS)
    return range_hash(sums, start, end, _BYTE_POWERS), np.searchsorted(start, offsets)


@dataclass
class Items:
    """A block of items over its own terms 0..V-1 (in the order of their hashes)."""

    ids: list
    vocabulary: np.ndarray  # hashes, ascending
    terms: list[np.ndarray]  # of each item, ascending
    weights: np.ndarray | None = None  # of each term

    @classmethod
    def of(cls, rows: list[tuple[object, list[str]]]) -> Items:
        words = sorted({t for _, terms in rows for t in terms})
        data = [w.encode() for w in words]
        offsets = np.cumsum([0, *map(len, data)])
        found, _ = _hashes(np.frombuffer(b"".join(data), np.uint8), offsets)
        vocabulary, place = np.unique(found, return_inverse=True)
        number = dict(zip(words, place.tolist(), strict=True))
        return cls([i for i, _ in rows], vocabulary, [np.unique([number[t] for t in terms]) for _, terms in rows])


class Coordinates:
    """Per term the terms of all items that hold it, made when they are asked for."""

    def __init__(self, items: Items):
        self.terms = items.terms
        sizes = [len(t) for t in items.terms]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        held = np.concatenate(items.terms)
        self.holder = owner[np.argsort(held, kind="stable")]
        self.first = np.searchsorted(np.sort(held), np.arange(len(items.vocabulary) + 1))
        self.known: dict[int, np.ndarray] = {}
        self.size = 0

    def __getitem__(self, t: int) -> np.ndarray:
        if t not in self.known:
            found = np.unique(np.concatenate([self.terms[i] for i in self.holder[self.first[t] : self.first[t + 1]]]))
            if self.size + len(found) > REMEMBERED:
                self.known, self.size = {}, 0
            self.known[t] = found
            self.size += len(found)
        return self.known[t]


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """Items with a term, in blocks of at most ``ITEMS`` items and ``TERMS`` terms (or one item)."""
    rows, seen = [], set()
    for r in items.select("item_id", "text").toLocalIterator():
        terms = list(dict.fromkeys(terms_of(r["text"])))
        if not terms:
            continue
        if rows and (len(rows) == ITEMS or len(seen | set(terms)) > TERMS):
            yield Items.of(rows)
            rows, seen = [], set()
        rows.append((r["item_id"], terms))
        seen |= set(terms)
    if rows:
        yield Items.of(rows)


def _names(ddl: str) -> list[str]:
    return [column.split()[0] for column in ddl.split(", ")]


def _lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))


VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """Per document its number of terms and the frequencies of the vocabulary's terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(vocabulary)
        for batch in batches:
            for lo, hi, buf, offsets in text_chunks(batch.column(1)):
                found, first = _hashes(buf, offsets)
                place = np.minimum(np.searchsorted(vocabulary, found), size - 1)
                hit = vocabulary[place] == found
                owner = np.repeat(np.arange(hi - lo), np.diff(first))
                keys, counts = np.unique(owner[hit] * size + place[hit], return_counts=True)
                ends = np.searchsorted(keys, np.arange(hi - lo + 1) * size)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(np.diff(first), pa.int64()),
                        _lists(keys % size, ends, pa.int32()),
                        _lists(counts, ends, pa.int32()),
                    ],
                    names=_names(VECTORS),
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, VECTORS)


def weighted(table: DataFrame, items: Items) -> tuple[Items, int, int]:
    """The items with their terms' weights, and ``N`` and ``L``; a sum per term reaches the driver."""
    total = table.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    held = table.select(F.explode("terms").alias("term")).groupBy("term").count()
    df = np.zeros(len(items.vocabulary), np.int64)
    for r in held.toLocalIterator():  # at most a row per term of the block
        df[r["term"]] = r["count"]
    weights = np.floor(1000 * np.log((2 * total["docs"] + 2) / (2 * df + 1))).astype(np.int64)
    return Items(items.ids, items.vocabulary, items.terms, weights), int(total["docs"]), int(total["length"])


def with_signature(table: DataFrame, items: Items, n_docs: int, length: int) -> DataFrame:
    """Documents that hold a term: ``doc_id, terms, gains, signature``."""
    schema = "doc_id long, terms array<int>, gains array<int>, signature long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = mix(items.vocabulary)
        planes = [np.where((bits >> np.uint64(b)) & np.uint64(1), items.weights, -items.weights).astype(float) for b in range(PLANES)]
        for batch in batches:
            terms, tfs = batch.column(2), batch.column(3)
            first = np.asarray(terms.offsets, np.int64)
            first = first - first[0]
            term, tf = np.asarray(terms.flatten(), np.int64), np.asarray(tfs.flatten(), np.int64)
            if not len(term):
                continue
            m = 50 + (50 * np.asarray(batch.column(1), np.int64) * n_docs) // length
            gain = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, np.diff(first)))
            signature = np.zeros(len(m), np.int64)
            some = np.diff(first) > 0
            for plane in planes:
                side = np.zeros(len(m))
                side[some] = np.add.reduceat(plane[term] * gain, first[:-1][some])
                signature = signature * 2 + (side > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _lists(term, first, pa.int32()), _lists(gain, first, pa.int32()), pa.array(signature)],
                names=_names(schema),
            )

    return table.filter(F.size("terms") > 0).mapInArrow(run, schema)


RUN = [  # the arrays of a run
    "doc_id", "first", "terms", "gains",  # documents and their vectors
    "list", "list_first", "posting",  # terms with a list, and its documents in order
    "summary_first", "summary",  # per list the maxima of its blocks, a row of coordinates each
]


def packed(run: list[pa.Array]) -> bytes:
    """A run as one compressed Arrow message: it is read whole or not at all, so columns would gain nothing."""
    row = pa.RecordBatch.from_arrays([_lists(v, np.array([0, len(v)]), v.type) for v in run], names=RUN)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(row)
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> dict[str, pa.Array]:
    row = pa.ipc.open_stream(data).read_next_batch()
    return {name: row.column(k).flatten() for k, name in enumerate(RUN)}


def _rows_of(first: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of the entries of the chosen vectors."""
    sizes = first[chosen + 1] - first[chosen]
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[chosen] - (ends - sizes), sizes)


def build_run(first: np.ndarray, terms: np.ndarray, gains: np.ndarray, coordinates: Coordinates, n_terms: int) -> list[np.ndarray]:
    """The arrays of ``RUN`` but the first for some documents in signature order."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.argsort(terms, kind="stable")
    posting = owner[order]
    listed, list_first = np.unique(terms[order], return_index=True)
    list_first = np.append(list_first, len(order))
    summary, ends, row = [], [0], np.zeros(n_terms, np.int32)
    for k, t in enumerate(listed.tolist()):
        lo, hi = list_first[k], list_first[k + 1]
        size = 0
        for a in range(lo, hi, BLOCK) if hi - lo >= LEAST else ():
            entries = _rows_of(first, posting[a : min(a + BLOCK, hi)])
            row[:] = 0
            np.maximum.at(row, terms[entries], gains[entries])
            summary.append(row[coordinates[t]])
            size += len(coordinates[t])
        ends.append(ends[-1] + size)
    flat = np.concatenate(summary) if summary else np.zeros(0, np.int32)
    return [first, terms, gains, listed, list_first, posting, np.array(ends), flat]


def index(spark: SparkSession, signed: DataFrame, coordinates: Coordinates, n_terms: int) -> DataFrame:
    """The table of runs."""

    def batch_of(parts: list[tuple]) -> pa.RecordBatch:
        doc_id = pa.concat_arrays([p[0] for p in parts])
        first = np.cumsum(np.concatenate([[0], *[p[1] for p in parts]]))
        found = build_run(first, *(np.concatenate([p[k] for p in parts]) for k in (2, 3)), coordinates, n_terms)
        run = packed([doc_id, *(pa.array(v.astype(np.int64 if n == "summary_first" else np.int32)) for n, v in zip(RUN[1:], found, strict=True))])
        return pa.RecordBatch.from_arrays([pa.array([run], pa.binary())], names=["run"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, docs, postings = [], 0, 0
        for batch in batches:
            sizes = np.diff(np.asarray(batch.column(1).offsets, np.int64))
            places = np.concatenate([[0], np.cumsum(sizes)])
            term, gain = np.asarray(batch.column(1).flatten()), np.asarray(batch.column(2).flatten())
            lo = 0
            while lo < len(sizes):
                room = np.searchsorted(places, places[lo] + RUN_POSTINGS - postings, "right") - 1
                hi = int(min(len(sizes), lo + RUN_DOCS - docs, max(room, lo + (not docs))))
                if hi > lo:
                    a, b = places[lo], places[hi]
                    parts.append((batch.column(0).slice(lo, hi - lo), sizes[lo:hi], term[a:b], gain[a:b]))
                    docs, postings = docs + hi - lo, postings + int(b - a)
                if hi < len(sizes):
                    yield batch_of(parts)
                    parts, docs, postings = [], 0, 0
                lo = hi
        if parts:
            yield batch_of(parts)

    ordered = signed.withColumn("place", F.monotonically_increasing_id())  # splits documents of one signature too
    ordered = ordered.repartitionByRange("signature", "place").sortWithinPartitions("signature", "place")
    return materialize(ordered.select("doc_id", "terms", "gains").mapInArrow(run, "run binary"), spark, "ranked_runs")


class Run:
    """A run that is read back, and its search for one item after the other."""

    def __init__(self, data: bytes, items: Items, coordinates: Coordinates):
        arrays = unpacked(data)
        self.known = np.asarray(arrays["doc_id"].is_valid())
        self.doc_id = np.asarray(arrays["doc_id"].fill_null(-1))
        self.first, self.terms, self.gains, self.list, self.list_first, self.posting, self.summary_first, self.summary = (np.asarray(arrays[n]) for n in RUN[1:])
        self.items, self.coordinates = items, coordinates
        self.place = {t: k for k, t in enumerate(self.list.tolist())}
        size = len(items.vocabulary)
        owner = np.repeat(np.arange(len(self.first) - 1, dtype=np.int64), np.diff(self.first))
        self.keys = owner * size + self.terms
        by_term = self.gains[np.argsort(self.terms, kind="stable")]
        self.greatest = np.maximum.reduceat(by_term, self.list_first[:-1]) * items.weights[self.list]

    def bounds(self, k: int, terms: np.ndarray) -> np.ndarray | None:
        """The summary scores of the blocks of list ``k``; None if it has none."""
        lo, hi = self.summary_first[k], self.summary_first[k + 1]
        if lo == hi:
            return None
        coordinates = self.coordinates[self.list[k]]
        blocks = self.summary[lo:hi].reshape(-1, len(coordinates))
        return blocks[:, np.searchsorted(coordinates, terms)] @ self.items.weights[terms]

    def block(self, k: int, b: int) -> np.ndarray:
        lo = self.list_first[k] + b * BLOCK
        return self.posting[lo : min(lo + BLOCK, self.list_first[k + 1])]

    def scores(self, docs: np.ndarray, terms: np.ndarray) -> np.ndarray:
        out, step = np.zeros(len(docs), np.int64), max(1, REMEMBERED // len(terms))
        for lo in range(0, len(docs), step):
            some = docs[lo : lo + step].astype(np.int64)
            wanted = (some[:, None] * len(self.items.vocabulary) + terms[None, :]).ravel()
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            gain = np.where(self.keys[at] == wanted, self.gains[at], 0).reshape(len(some), len(terms))
            out[lo : lo + step] = gain @ self.items.weights[terms]
        return out

    def lists(self, terms: np.ndarray) -> list[int]:
        return [self.place[t] for t in terms.tolist() if t in self.place and self.items.weights[t] > 0]

    def seed(self, terms: np.ndarray) -> np.ndarray:
        """Documents of the block with the greatest bound (of the shortest list, where none has blocks)."""
        best, docs = -1, None
        lists = self.lists(terms)
        for k in lists:
            found = self.bounds(k, terms)
            if found is not None and found.max() > best:
                best, docs = found.max(), self.block(k, int(found.argmax()))
        if docs is None and lists:
            k = max(lists, key=lambda k: self.greatest[k])
            docs = self.posting[self.list_first[k] : self.list_first[k + 1]]
        return np.zeros(0, np.int64) if docs is None else docs

    def candidates(self, terms: np.ndarray, least: int) -> np.ndarray:
        """All documents that may score ``least``, in lists and blocks whose bounds allow it."""
        lists = sorted(self.lists(terms), key=lambda k: self.greatest[k])
        together, found = 0, []
        for k in lists:
            together += self.greatest[k]
            if together < least:  # documents that are in such lists only
                continue
            bounds = self.bounds(k, terms)
            if bounds is None:
                found.append(self.posting[self.list_first[k] : self.list_first[k + 1]])
            else:
                found += [self.block(k, b) for b in np.flatnonzero(bounds >= least).tolist()]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


HITS = "item int, doc_id long, score long"


def search(runs: DataFrame, items: Items, coordinates: Coordinates, least: np.ndarray | None, top: int) -> DataFrame:
    """Every run's ``top`` documents per item: of the seeds, or of all that may score ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                part, hits = Run(data.as_py(), items, coordinates), []
                for q, terms in enumerate(items.terms):
                    docs = part.seed(terms) if least is None else part.candidates(terms, int(least[q]))
                    score = part.scores(docs, terms)
                    good = score >= (1 if least is None else least[q])
                    docs, score = docs[good], score[good]
                    best = np.lexsort((part.doc_id[docs], ~part.known[docs], -score))[:top]
                    hits.append((np.full(len(best), q), docs[best], score[best]))
                item, docs, score = (np.concatenate(x) for x in zip(*hits, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.int32()), pa.array(part.doc_id[docs], pa.int64(), mask=~part.known[docs]), pa.array(score, pa.int64())],
                    names=_names(HITS),
                )

    return runs.mapInArrow(run, HITS)


def _best(hits: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def rank(spark: SparkSession, docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` documents with a positive score."""
    out = scratch_path(spark, "ranked_hits")
    spark.createDataFrame([], "item_id long, rank int, doc_id long, score long").write.parquet(out)
    for block in item_blocks(items):
        table = materialize(vectors(docs, block.vocabulary), spark, "ranked_vectors")
        block, n_docs, length = weighted(table, block)
        if not n_docs:
            continue
        coordinates = Coordinates(block)
        signed = materialize(with_signature(table, block, n_docs, length), spark, "ranked_signed")
        runs = index(spark, signed, coordinates, len(block.vocabulary))
        each = min(top, -(-4 * top // max(1, runs.count())))  # seeds of a run: any scores that occur give a bound
        seeds = _best(search(runs, block, coordinates, None, each), top).filter(F.col("rank") == top)
        least = np.ones(len(block.ids), np.int64)
        for r in seeds.select("item", "score").collect():  # a row per item of the block
            least[r["item"]] = max(1, r["score"])
        hits = _best(search(runs, block, coordinates, least, top), top)
        names = F.broadcast(spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id long"))  # at most ITEMS rows
        hits.join(names, "item").select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(out)
    return spark.read.parquet(out)
