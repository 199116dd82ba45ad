"""Substring deduplication with suffix automata of reference shards.

A window is ``min_words`` consecutive words of a document. A word is removed
if a window that covers it also starts in a document with a smaller id.

Sending every document past the automaton of every shard would cost the
square of the corpus, so shards are made by content and only the passages
that can match a shard are streamed past it:

1. Each window is assigned the smallest hash of its ``GRAM``-word runs, its
   anchor. Equal windows have equal anchors, wherever they stand. Windows in
   a row with one anchor form a segment; a document has about one segment per
   twenty words, and only (anchor, segment hash, document, place) is kept.
2. Anchors of one document only cannot match and are dropped.
3. Equal segments are one reference segment, labelled with its first
   document. Every later document holding it loses all its windows.
4. The different segments of an anchor are a reference shard. Its suffix
   automaton is built in order of the first documents; each segment is
   streamed past the automaton of the smaller documents for matching
   statistics, and the spans at least ``min_words`` long are maximal
   duplicates. The automaton is exact: it works on words, not hashes.
5. A shard of more than ``SHARD_SEGMENTS`` segments (a passage in very many
   surroundings) is not gathered: its windows are matched one by one through
   an aggregate by window, which is combined before the shuffle.

Texts are shuffled twice: to cut the segments of step 4 and to remove words.

Null texts have no words. Rows with a null id lose nothing and cause no loss;
rows that share an id are one document's (neither removes from the other).
Texts under ``min_words`` words lose nothing. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.frames import typed
from mercato.llm.words import Words, mix, prefix_sums, range_hash, text_chunks, to_int64
from mercato.session import materialize

MIN_WORDS = 50
GRAM = 12
SHARD_SEGMENTS = 512


class SuffixAutomaton:
    """Suffix automaton of several word sequences (states: transitions, link, longest length)."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, transitions: dict[bytes, int], link: int, length: int) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """A copy of q for the suffixes that p reaches by ``word``."""
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:  # the prefix is known already
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
                continue
            new, p = self._state({}, 0, self.length[last] + 1), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            last = new

    def statistics(self, words: list[bytes]) -> list[int]:
        """For each position the length of the longest match that ends there."""
        state, n, out = 0, 0, []
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                n = self.length[state]
            q = self.next[state].get(word)
            if q is not None:
                state, n = q, n + 1
            out.append(n)
        return out


def _ranges(starts: list[int]) -> list[dict[str, int]]:
    """Ascending window starts as maximal ranges [lo, hi)."""
    out: list[dict[str, int]] = []
    for i in starts:
        if out and out[-1]["hi"] == i:
            out[-1]["hi"] = i + 1
        else:
            out.append({"lo": i, "hi": i + 1})
    return out


def _segment_rows(words: Words, size: int) -> tuple[np.ndarray, ...]:
    """``(anchor, segment, text, start, windows)`` of all segments; start counts from the text's first word."""
    n = len(words)
    gram = min(GRAM, size)
    if n < size:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    sums = prefix_sums(words.hash)
    owner = words.owner()
    at = np.arange(n - gram + 1)
    grams = range_hash(sums, at, at + gram)
    view = np.lib.stride_tricks.sliding_window_view(grams, size - gram + 1)
    starts = np.flatnonzero(owner[: n - size + 1] == owner[size - 1 :])  # windows inside one text
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    anchor_at = starts + view[starts].argmin(axis=1)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor_at[1:] != anchor_at[:-1]) | (starts[1:] != starts[:-1] + 1) | (owner[starts[1:]] != owner[starts[:-1]])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    begin = starts[first]
    text = owner[begin]
    segment = range_hash(sums, begin, begin + count + size - 1)
    return to_int64(grams[anchor_at[first]]), to_int64(segment), text, begin - words.first[text], count


SEGMENT_SCHEMA = "anchor long, segment long, doc_id long, start int, n int"


def segments(docs: DataFrame, size: int) -> DataFrame:
    schema = typed(SEGMENT_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, buf, offsets in text_chunks(batch.column(1)):
                anchor, segment, text, start, n = _segment_rows(Words(buf, offsets), size)
                if len(anchor):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(segment), batch.column(0).take(pa.array(text + lo)), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                        names=schema.fieldNames(),
                    )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.filter(F.col("doc_id").isNotNull()).mapInArrow(run, schema)


def _cut(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The words of ``wanted`` segments: (anchor, segment, first_doc, m, text)."""
    lists = wanted.groupBy(F.col("first_doc").alias("__doc")).agg(
        F.collect_list(F.struct("segment", "start", "n", "anchor", "m")).alias("cuts")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = rows.join(lists, F.col("doc_id") == F.col("__doc")).select("doc_id", "text", "cuts")
    schema = typed("anchor long, segment long, first_doc long, m long, text binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in text_chunks(batch.column(1)):
                words, data, out = Words(buf, offsets), buf.tobytes(), []
                sums, doc_ids, cuts = prefix_sums(words.hash), batch.column(0), batch.column(2)
                for i in range(hi - lo):
                    a, b = int(words.first[i]), int(words.first[i + 1])
                    own = [data[s:e] for s, e in zip(words.start[a:b].tolist(), words.end[a:b].tolist(), strict=True)]
                    doc = doc_ids[lo + i].as_py()
                    for c in cuts[lo + i].as_py():
                        s, e = c["start"], c["start"] + c["n"] + size - 1
                        if e <= len(own) and _holds(sums, a + s, a + e, c["segment"]):
                            out.append((c["anchor"], c["segment"], doc, c["m"], b" ".join(own[s:e])))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*out, strict=True), [pa.int64()] * 4 + [pa.binary()], strict=True)],
                        names=schema.fieldNames(),
                    )

    return joined.mapInArrow(run, schema)


def _holds(sums: np.ndarray, start: int, end: int, segment: int) -> bool:
    """Whether the words really are the segment (rows may share an id)."""
    return int(to_int64(range_hash(sums, np.array([start]), np.array([end])))[0]) == segment


RANGE_SCHEMA = "anchor long, segment long, ranges array<struct<lo int, hi int>>"


def _automata(texts: DataFrame, size: int) -> DataFrame:
    """Duplicate window ranges of each segment against its shard's smaller documents."""
    schema = typed(RANGE_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, automaton, waiting, waiting_doc = None, None, [], None
        for batch in batches:
            out = []
            for a, segment, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if a != anchor:
                    anchor, automaton, waiting, waiting_doc = a, SuffixAutomaton(), [], doc
                if doc != waiting_doc:  # a document does not remove from itself
                    for w in waiting:
                        automaton.add(w)
                    waiting, waiting_doc = [], doc
                words = text.split(b" ")
                found = [i - size + 1 for i, n in enumerate(automaton.statistics(words)) if n >= size]
                if found:
                    out.append((a, segment, _ranges(found)))
                waiting.append(words)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.fieldNames(), r, strict=True)) for r in out], schema=_arrow(schema))

    shards = texts.select("anchor", "segment", "first_doc", "text").repartition("anchor")
    return shards.sortWithinPartitions("anchor", "first_doc", "segment").mapInArrow(run, schema)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _by_window(texts: DataFrame, size: int) -> DataFrame:
    """The ranges of very large shards, matched window by window."""
    schema = typed("w1 long, w2 long, anchor long, segment long, first_doc long, i int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, buf, offsets in text_chunks(batch.column(3).cast(pa.large_string())):
                words = Words(buf, offsets)
                count = np.maximum(np.diff(words.first) - size + 1, 0)
                text = np.repeat(np.arange(len(count)), count)
                i = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
                at = words.first[text] + i
                keys = [to_int64(range_hash(prefix_sums(h), at, at + size)) for h in (words.hash, mix(words.hash))]
                rows = pa.array(text + lo)
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, keys), *(batch.column(c).take(rows) for c in range(3)), pa.array(i.astype(np.int32))],
                    names=schema.fieldNames(),
                )

    windows = texts.select("anchor", "segment", "first_doc", F.col("text").cast("string")).mapInArrow(run, schema)
    windows = materialize(windows, texts.sparkSession, "windows")
    first = windows.groupBy("w1", "w2").agg(F.min("first_doc").alias("d"), F.max("first_doc").alias("d1"))
    first = materialize(first.filter("d < d1").select("w1", "w2", "d"), texts.sparkSession, "first_windows")
    later = windows.join(first, ["w1", "w2"]).filter("first_doc > d")
    ranges = F.transform(F.array_sort(F.collect_set("i")), lambda i: F.struct(i.alias("lo"), (i + 1).alias("hi")))
    return later.groupBy("anchor", "segment").agg(ranges.alias("ranges"))


def duplicate_spans(spark: SparkSession, docs: DataFrame, size: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, segment, start, n, lo, hi)``: windows [start + lo, start + hi) of a document are duplicates."""
    rows = segments(docs, size)
    shared = rows.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    shared = materialize(shared.select("anchor"), spark, "shared_anchors")
    rows = materialize(rows.join(shared, "anchor"), spark, "segments")
    refs = rows.groupBy("anchor", "segment").agg(
        F.min("doc_id").alias("first_doc"), F.min_by("start", "doc_id").alias("start"), F.max("n").alias("n")
    )
    refs = materialize(refs, spark, "references")
    shards = refs.groupBy("anchor").agg(F.count("*").alias("m")).filter("m > 1")
    texts = materialize(_cut(docs, refs.join(materialize(shards, spark, "shards"), "anchor"), size), spark, "shard_texts")
    ranges = _automata(texts.filter(F.col("m") <= SHARD_SEGMENTS), size)
    large = texts.filter(F.col("m") > SHARD_SEGMENTS)
    ranges = materialize(ranges.unionByName(_by_window(large, size)), spark, "ranges")
    placed = rows.join(refs.select("anchor", "segment", "first_doc"), ["anchor", "segment"])
    whole = placed.filter(F.col("doc_id") > F.col("first_doc")).select(
        "doc_id", "segment", "start", "n", F.lit(0).alias("lo"), F.col("n").alias("hi")
    )
    part = placed.filter(F.col("doc_id") == F.col("first_doc")).join(ranges, ["anchor", "segment"])
    part = part.select("doc_id", "segment", "start", "n", F.explode("ranges").alias("r"))
    return whole.unionByName(part.select("doc_id", "segment", "start", "n", "r.lo", "r.hi"))


def deduplicate(spark: SparkSession, docs: DataFrame, size: int = MIN_WORDS, keep_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row; ``keep_text`` adds the kept words."""
    spans = duplicate_spans(spark, docs, size)
    lists = spans.groupBy(F.col("doc_id").alias("__doc")).agg(
        F.collect_list(F.struct("segment", "start", "n", "lo", "hi")).alias("spans")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = rows.join(materialize(lists, spark, "spans"), F.col("doc_id") == F.col("__doc"), "left")
    schema = typed("doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in text_chunks(batch.column(1)):
                data, at = buf.tobytes(), offsets.tolist()
                first = sums = None
                total, removed, sha, kept = [], [], [], []
                for i in range(hi - lo):
                    words = data[at[i] : at[i + 1]].split()  # ASCII white space, on bytes
                    n, spans = len(words), batch.column(2)[lo + i]
                    if spans.is_valid:
                        if sums is None:
                            found = Words(buf, offsets)
                            first, sums = found.first, prefix_sums(found.hash)
                        gone, base = np.zeros(n, bool), int(first[i])
                        for s in spans.as_py():
                            end = s["start"] + s["n"] + size - 1
                            if end <= n and _holds(sums, base + s["start"], base + end, s["segment"]):
                                gone[s["start"] + s["lo"] : s["start"] + s["hi"] + size - 1] = True
                        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    text = b" ".join(words)
                    total.append(n)
                    removed.append(n - len(words))
                    sha.append(hashlib.sha256(text).hexdigest())
                    kept.append(text.decode() if keep_text else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha), pa.array(kept, pa.string())],
                    names=schema.fieldNames(),
                )

    out = joined.select("doc_id", "text", "spans").mapInArrow(run, schema)
    return out if keep_text else out.drop("kept")
