"""Best-fit decreasing packing of tokenised documents into fixed-length sequences.

1. Every document is tokenised once (an end token follows its ids), cut
   into pieces only where it is longer than a sequence, and each piece is
   described by one small row. The rows are written to the shared
   checkpoint folder.
2. Lengths are integers up to ``max_len``, so the histogram of piece
   lengths (at most ``max_len`` rows, whatever the corpus) holds all that
   best-fit decreasing looks at. The driver runs it on the histogram:
   lengths in falling order, and for each the tightest open bin, found in
   logarithmic time by a segment tree over remaining capacities. Bins with
   equal remaining capacity are kept as intervals, so equal pieces are
   placed in runs rather than one by one. The result is the packing that
   placing the corpus's pieces one at a time would give, not one per task.
3. A piece's rank among the pieces of its length (rank in its task plus
   the counts of the tasks before) selects its run, and so its bin.

No group is collected: a length that a third of all pieces share is ranked
inside each scan task.

Null texts are empty documents (the end token only); rows are packed one by
one, so repeated rows and null ids are packed like any other; an empty
table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.frames import running_base, typed
from mercato.llm.words import Words, text_chunks
from mercato.session import materialize

MAX_LEN = 2048
END_ID = 0
CACHED_WORDS = 500_000  # words whose ids a worker remembers; beyond it the memory starts anew
BATCH = 1000  # words given to the tokenizer at once

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>, pid int, lrank long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class SegmentTree:
    """Which remaining capacities 0..n have open bins; the smallest one >= c in O(log n)."""

    def __init__(self, n: int):
        self.size = 1 << (n + 1).bit_length()
        self.any = bytearray(2 * self.size)

    def set(self, c: int, on: bool) -> None:
        i = self.size + c
        self.any[i] = on
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def at_least(self, c: int) -> int | None:
        i = self.size + c
        if self.any[i]:
            return c
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:  # the nearest subtree to the right with an open bin
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit_runs(histogram: dict[int, int], max_len: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``{length: count}``.

    Returns runs ``(length, lo, hi, first_bin, per_bin, offset)``: the pieces
    of that length with rank in [lo, hi) fill bins from ``first_bin`` on,
    ``per_bin`` in each, the first one at ``offset``."""
    tree, open_bins, runs, bins = SegmentTree(max_len), {}, [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            open_bins.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.at_least(length)
            if room is None:
                room, per = max_len, max_len // length
                first, n = bins, -(-left // per)
                bins += n
            else:
                per = room // length
                first, n = open_bins[room].pop()
                if not open_bins[room]:
                    tree.set(room, False)
            full = min(n, left // per)
            if full:
                runs.append((length, rank, rank + full * per, first, per, max_len - room))
                put(room - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if left and full < n:  # one bin takes the rest, fewer than fill it
                runs.append((length, rank, rank + left, first + full, left, max_len - room))
                put(room - left * length, first + full, 1)
                full, left = full + 1, 0
            put(room, first + full, n - full)
    return runs


class _Encoder:
    """Token ids of many texts; each distinct word is tokenised once.

    The vocabulary drops white space and never merges over it, nor over the
    border between a letter or digit and following punctuation, so the ids
    of a text are those of its parts in turn."""

    BREAKS = np.zeros(256, bool)
    BREAKS[list(b".,;:!?*%$&#|")] = True
    ALNUM = np.zeros(256, bool)
    ALNUM[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True

    LETTERS = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+")  # lower-case ASCII and Latin-1

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # the byte-level alphabet
        self.alphabet = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        self.clear()

    @classmethod
    def of_worker(cls, vocabulary: str) -> _Encoder:
        """The worker process's encoder: tasks that follow one another share what it has learnt.

        Code that travels with a task gets new globals in each task, so it
        is kept on a module that is imported."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import tokenizers

        kept = tokenizers.__dict__.setdefault("_mercato_encoders", {})
        if vocabulary not in kept:
            kept[vocabulary] = cls(vocabulary)
        return kept[vocabulary]

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.zeros(1 << 20, np.int32)
        self.used = 0
        self.at = np.zeros(1 << 16, np.int64)  # of known word k: ids[at[k]:at[k + 1]]

    def _ids(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of some words. A word of letters is one unit of the vocabulary's
        splitter, so the merges are asked for directly; others take the full way."""
        for lo in range(0, len(texts), BATCH):
            part = texts[lo : lo + BATCH]
            plain = [self.LETTERS.fullmatch(t.lower()) for t in part]
            rest = [t for t, m in zip(part, plain, strict=True) if not m]
            full = iter(self.tokenizer.encode_batch(rest, add_special_tokens=False))
            for m in plain:
                if m:
                    word = m.group()
                    if not word.isascii():
                        word = word.encode().decode("latin-1").translate(self.alphabet)
                    yield [t.id for t in self.model.tokenize(word)]
                else:
                    yield next(full).ids

    def _learn(self, keys: list[int], texts: list[str]) -> None:
        for key, ids in zip(keys, self._ids(texts), strict=True):
            k = len(self.known)
            end = self.used + len(ids)
            if end > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(ids)), np.int32)])
            if k + 2 > len(self.at):
                self.at = np.concatenate([self.at, np.zeros(len(self.at), np.int64)])
            self.ids[self.used : end] = ids
            self.used = end
            self.at[k + 1] = end
            self.known[key] = k

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end token, and the texts' borders in them.

        The tokenizer finds the strings of its special tokens anywhere, also
        inside words; a text that holds one is given to it whole."""
        data = buf.tobytes()
        if not any(s in data for s in self.special):
            return self._encode_words(buf, offsets)
        ids, sizes, lo = [], [], 0
        for i in range(len(offsets)):
            text = data[offsets[i] : offsets[i + 1]] if i + 1 < len(offsets) else None
            if text is not None and not any(s in text for s in self.special):
                continue
            if i > lo:  # the texts before
                part, borders = self._encode_words(buf[offsets[lo] : offsets[i]], offsets[lo : i + 1] - offsets[lo])
                ids.append(part)
                sizes.append(np.diff(borders))
            if text is not None:
                ids.append(np.array([*self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, END_ID], np.int32))
                sizes.append(np.array([len(ids[-1])]))
            lo = i + 1
        return np.concatenate(ids), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    def _encode_words(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = Words(buf, offsets, lower=True, breaks=self._breaks(buf))
        uniq, where, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.known) + len(uniq) > CACHED_WORDS:
            self.clear()
        keys = uniq.tolist()
        new = [i for i, k in enumerate(keys) if k not in self.known]
        if new:
            data = buf.tobytes()
            spans = zip(words.start[where[new]].tolist(), words.end[where[new]].tolist(), strict=True)
            self._learn([keys[i] for i in new], [data[s:e].decode() for s, e in spans])
        slot = np.fromiter((self.known[k] for k in keys), np.int64, len(keys))[inverse]
        begin, count = self.at[slot], self.at[slot + 1] - self.at[slot]
        # one end token behind each text's words
        ends = words.first[1:]
        begin = np.insert(begin, ends, -1)
        count = np.insert(count, ends, 1)
        total = np.concatenate([[0], np.cumsum(count)])
        source = np.repeat(begin - total[:-1], count) + np.arange(total[-1])
        borders = total[np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])]
        out = self.ids[np.maximum(source, 0)]
        out[borders[1:] - 1] = END_ID
        return out, borders

    def _breaks(self, buf: np.ndarray) -> np.ndarray:
        """Where a word may be cut: punctuation after an ASCII or Latin-1 letter or digit."""
        before = self.ALNUM[buf]
        latin = np.zeros(len(buf), bool)
        if len(buf) > 1:
            latin[1:] = (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
        cut = np.zeros(len(buf), bool)
        cut[1:] = (before | latin)[:-1] & self.BREAKS[buf[1:]]
        return cut


def pieces(docs: DataFrame, vocabulary: str, max_len: int = MAX_LEN, keep_ids: bool = False) -> DataFrame:
    """One row per piece; ``pid``/``lrank`` give its place among equal lengths of its task."""
    schema = typed(PIECE_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, pid = _Encoder.of_worker(vocabulary), np.zeros(max_len + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            doc_ids = batch.column(0)
            for lo, hi, buf, offsets in text_chunks(batch.column(1)):
                ids, borders = encoder.encode(buf, offsets)
                sizes = np.diff(borders)
                n = -(-sizes // max_len)
                doc = np.repeat(np.arange(hi - lo), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * max_len
                length = np.minimum(sizes[doc] - start, max_len)
                a = borders[:-1][doc] + start
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(a.tolist(), (a + length).tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                by = length[order]
                rank = np.empty(len(by), np.int64)
                rank[order] = np.arange(len(by)) - np.searchsorted(by, by)
                rank += seen[length]
                seen += np.bincount(length, minlength=max_len + 1)
                if keep_ids:
                    kept = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(ids))
                else:
                    kept = pa.nulls(len(doc), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(lo, hi - lo).take(pa.array(doc)),
                        pa.array(piece, pa.int32()),
                        pa.array(start),
                        pa.array(length),
                        pa.array(crc, pa.int64()),
                        kept,
                        pa.array(np.full(len(doc), pid), pa.int32()),
                        pa.array(rank),
                    ],
                    names=schema.fieldNames(),
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def pack(
    spark: SparkSession,
    docs: DataFrame,
    vocabulary: str | None = None,
    max_len: int = MAX_LEN,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents with their sequence and place in it.

    ``keep_ids`` adds the token ids of each piece; without it the column is
    left out and only the checksum of the ids travels."""
    table = materialize(pieces(docs, vocabulary or default_vocabulary(), max_len, keep_ids), spark, "pieces")
    counts = table.groupBy("pid", "length").agg(F.count("*").alias("n"))
    counts = materialize(counts, spark, "piece_counts")
    # at most max_len rows
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(
        best_fit_runs(histogram, max_len),
        T.StructType([T.StructField(c, T.LongType()) for c in ("length", "lo", "hi", "first_bin", "per_bin", "at")]),
    )
    placed = (
        table.join(running_base(counts, "length"), ["pid", "length"])
        .withColumn("rank", F.col("base") + F.col("lrank"))
        # bounded by the pairs of a length and a remaining capacity, not by the corpus
        .join(F.broadcast(runs), "length")
        .filter((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
        .withColumn("k", F.col("rank") - F.col("lo"))
    )
    out = placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_bin") + F.expr("k div per_bin")).alias("sequence_id"),
        (F.col("at") + (F.col("k") % F.col("per_bin")) * F.col("length")).alias("offset"),
        "ids",
    )
    return out if keep_ids else out.drop("ids")
