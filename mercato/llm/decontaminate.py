"""Benchmark decontamination by template canonicalisation.

Documents and benchmark items are turned into templates: tokens (runs of
letters and digits, case folded, punctuation dropped) in which a number, a
unit after a number and a capitalised name inside a sentence are replaced by
a typed placeholder. Windows of ``WINDOW`` template tokens of a document are
looked up in a hash table of the items' windows, hits on one diagonal
(document position minus item position) are merged into runs, and each run
is checked for slot consistency: within a run every value of an item slot
must stand for one value in the document and the other way round. A copy
passes with equal values, a re-parameterised question with changed ones; a
run is cut where a slot contradicts an earlier one, and parts of at least a
window remain. A template window needs ``MIN_LITERAL`` literal tokens;
windows are looked up by their case-folded values as well, which need none,
so an exact copy is found whatever it consists of.

A token's type depends on what stands before it and on its case. So windows
have further readings on both sides: names as plain words (a copy in other
case may still change its numbers), and the first token as a plain word.

Everything is a join of tables:

* Items of one template (equal codes, and equal slots in the same places) are
  one class; :func:`members` lists them. A benchmark of thousands of
  arithmetic questions of one form is one class, and a document that holds
  one of them is one row, not thousands.
* ``item_windows`` has a row per window hash, class and place.
* A pass over the documents looks their windows up in a bit filter of the
  item hashes (at most ``2 ** FILTER_BITS`` bits, whatever the benchmark), and
  keeps the windows that it may hold, with their tokens. Copies of a text are
  one from here on.
* These are hash-joined with the item windows by Spark, which broadcasts
  either side only below its size limit, and the runs of each text and
  class are checked.

Only windows that the filter lets through are shuffled. :func:`clean` takes the
documents out whose text's hash is among the confirmed ones (an anti join, which
Spark does by broadcast below its size limit).

Null texts, and null items or items without tokens, match nothing; an item
shorter than a window is matched whole. Repeated rows, and rows without an id, are
reported once per row. Very long texts are read whole, as one chunk. Empty
tables give empty results. Other columns, whatever their names, are kept by :func:`clean`
and ignored by :func:`matches`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.frames import typed
from mercato.llm.words import _BYTE_POWERS, _BYTES, mix, prefix_sums, range_hash, text_chunks, to_int64
from mercato.session import materialize

WINDOW = 10  # template tokens
MIN_LITERAL = 6  # of a template window: the rest may be placeholders
FILTER_BITS = 27  # of the filter at most
BITS_PER_WINDOW = 1024

LITERAL, NUMBER, UNIT, NAME = range(4)
# fixed values: units that may follow a number
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l s sec min h hr hrs ms hz khz mhz ghz w kw v a j kj "
    "cal kcal pa kpa bar k c f percent pct usd eur gbp dollars dollar euros euro cents cent pounds pound "
    "meters meter metres metre kilometers kilometer kilometres kilometre miles mile feet foot inches inch "
    "grams gram kilograms kilogram liters liter litres litre seconds second minutes minute hours hour days "
    "day weeks week months month years year degrees degree apples people students"
).split()

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_TOKEN = np.zeros(256, bool)
_TOKEN[48:58] = _TOKEN[65:91] = _TOKEN[97:123] = True
_TOKEN[128:] = True
_STOP = np.zeros(256, bool)  # after one of these a capital is no name
_STOP[list(b".!?:;\n\r\"|")] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SLOT = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_HEAD = np.uint64(0x9FB21C651E98DF25)


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    ends = np.cumsum([len(u) + 1 for u in UNITS]) - 1
    return np.sort(range_hash(prefix_sums(_BYTES[data], _BYTE_POWERS), ends - [len(u) for u in UNITS], ends, _BYTE_POWERS))


class Templates:
    """Template tokens of some texts: value hash, type and code of each; ``first`` as in Words."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, units: np.ndarray):
        n = len(buf)
        before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
        if n:
            before[1:], after[:-1] = buf[:-1], buf[1:]
        digit = _DIGIT[buf]
        accent = (before == 0xC3) & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97)  # second byte of a Latin-1 capital
        folded = _FOLD[buf]
        folded[accent] += 32
        point = ((buf == 46) | (buf == 44)) & _DIGIT[before] & _DIGIT[after]  # inside a number
        token = _TOKEN[buf] | point
        kind = digit | point  # a border between digits and letters parts tokens
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        if n:
            edge[1:-1] |= kind[1:] != kind[:-1]
        follows = np.zeros(n, bool)
        follows[1:] = token[:-1]
        leads = np.zeros(n, bool)
        leads[:-1] = token[1:]
        self.start = np.flatnonzero(token & ~(follows & ~edge[:-1]))
        self.end = np.flatnonzero(token & ~(leads & ~edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.value = range_hash(prefix_sums(_BYTES[folded], _BYTE_POWERS), self.start, self.end, _BYTE_POWERS)
        m = len(self.start)
        opens = np.zeros(m, bool)  # the first token of a text
        opens[self.first[:-1][self.first[:-1] < m]] = True
        self.type = np.zeros(m, np.int8)
        if m:
            number = kind[self.start]
            stops = np.concatenate([[0], np.cumsum(_STOP[buf])])
            calm = np.zeros(m, bool)  # no stop between the token before and this one
            calm[1:] = stops[self.start[1:]] == stops[self.end[:-1]]
            nxt = np.minimum(self.start + 1, n - 1)
            capital = _UPPER[buf[self.start]] | ((buf[self.start] == 0xC3) & accent[nxt])
            small = ((buf[nxt] >= 97) & (buf[nxt] <= 122)) | (buf[nxt] >= 128)
            self.type[capital & small & calm & ~opens] = NAME
            self.type[number] = NUMBER
            unit = np.zeros(m, bool)
            unit[1:] = number[:-1] & ~opens[1:]
            unit[unit] = np.isin(self.value[unit], units)
            self.type[unit] = UNIT
        self.code = np.where(self.type == LITERAL, self.value, _SLOT[self.type])

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start tokens of the windows of ``size`` tokens inside one text, their hashes in all readings, and whether a reading holds all values."""
        m = len(self.start)
        if m < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
        last = np.repeat(self.first[1:], np.diff(self.first))
        at = np.flatnonzero(np.arange(m) + size <= last)
        typed, named = (np.concatenate([[0], np.cumsum(x)]) for x in (self.type != LITERAL, self.type == NAME))
        slots, names = typed[at + size] - typed[at], named[at + size] - named[at]
        unnamed = np.where(self.type == NAME, self.value, self.code)
        literal = min(size, MIN_LITERAL)
        starts, hashes, exact = [], [], []
        for code, n, use in (  # a reading, its placeholders, the windows in which it differs from those before
            (self.code, slots, size - slots >= literal),
            (unnamed, slots - names, (size - slots + names >= literal) & (names > 0) & (slots > names)),
            (self.value, 0 * slots, slots > 0),
        ):
            sums = prefix_sums(code)
            first = (code[at] != self.value[at]) & (size - n + 1 >= literal) & (n > 1)  # else all are values
            for head, x in ((code, use), (self.value, first)):
                starts.append(at[x])
                hashes.append(mix(range_hash(sums, at[x] + 1, at[x] + size) * _HEAD + head[at[x]]))
                exact.append(n[x] == 0)
        return np.concatenate(starts), np.concatenate(hashes), np.concatenate(exact)


def _consistent(values: np.ndarray, types: np.ndarray, item_values: np.ndarray, item_types: np.ndarray, size: int) -> list[tuple[int, int, int, int]]:
    """``(start, tokens, slots, changed slots)`` of the longest parts of a run in which slots map one to one."""
    slots = np.flatnonzero((types == item_types) & (item_types != LITERAL))
    kinds, ours, theirs = (x[slots].tolist() for x in (item_types, item_values, values))
    changed = values != item_values
    parts, there, back, begin = [], {}, {}, 0
    for p, k, a, b in zip(slots.tolist(), kinds, ours, theirs, strict=True):
        (b_then, p_a), (a_then, p_b) = there.get((k, a), (b, -1)), back.get((k, b), (a, -1))
        cut = max(begin, p_a + 1 if b_then != b else 0, p_b + 1 if a_then != a else 0)
        if cut > begin:  # goes on behind the token that contradicts this one
            parts.append((begin, p))
            begin = cut
        there[k, a], back[k, b] = (b, p), (a, p)
    out = []
    for lo, hi in [*parts, (begin, len(values))]:
        if hi - lo >= size:
            inside = slots[(slots >= lo) & (slots < hi)]
            out.append((lo, hi - lo, len(inside), int(changed[inside].sum())))
    return out


def _list(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat).cast(kind))


ITEM_SCHEMA = "item_id long, class long, values array<long>, types array<tinyint>, size array<int>, at array<int>, hash array<long>, exact array<boolean>"


def item_templates(benchmark: DataFrame) -> DataFrame:
    """A row per item with tokens: its class, its template tokens and its windows."""
    schema = typed(ITEM_SCHEMA)

    def one(item_id, text: str, units: np.ndarray) -> tuple | None:
        buf = np.frombuffer(text.encode(), np.uint8)
        t = Templates(buf, np.array([0, len(buf)]), units)
        if not len(t.value):
            return None
        seen: dict[tuple[int, int], int] = {}
        slot = [seen.setdefault((k, v), len(seen) + 1) if k != LITERAL else 0 for k, v in zip(t.type.tolist(), t.value.tolist(), strict=True)]
        sums = prefix_sums(t.code + mix(np.array(slot, np.uint64)))
        key = range_hash(sums, np.array([0]), np.array([len(slot)]))
        size = min(WINDOW, len(slot))
        at, hashes, exact = t.windows(size)
        return item_id, to_int64(key)[0], to_int64(t.value), t.type, np.full(len(at), size), at, to_int64(hashes), exact

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _unit_hashes()
        for batch in batches:
            found = [r for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if x and (r := one(i, x, units))]
            if found:
                columns = list(zip(*found, strict=True))
                lists = [_list(list(c), f.type.value_type) for c, f in zip(columns[2:], arrow[2:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *lists], names=schema.fieldNames())

    kinds = [pa.int64(), pa.int8(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
    arrow = [pa.field("item_id", pa.int64()), pa.field("class", pa.int64()), *(pa.field("x", pa.list_(k)) for k in kinds)]
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, schema), benchmark.sparkSession, "item_templates")


def members(templates: DataFrame) -> DataFrame:
    """``item_id`` (the class's smallest) and ``member_id`` of every item of :func:`item_templates`."""
    least = templates.groupBy("class").agg(F.min("item_id").alias("least"))
    return templates.join(least, "class").select(F.col("least").alias("item_id"), F.col("item_id").alias("member_id"))


def item_windows(templates: DataFrame) -> DataFrame:
    """``hash, size, class, item_at, exact``: the windows of all members, each once."""
    zipped = F.arrays_zip("size", "at", "hash", "exact")
    rows = templates.select("class", F.inline(zipped))
    rows = rows.groupBy("hash", "size", "class", F.col("at").alias("item_at")).agg(F.max("exact").alias("exact"))
    return materialize(rows, templates.sparkSession, "item_windows")


class WindowFilter:
    """Which window hashes may be an item's: two bits of each are set."""

    def __init__(self, n: int):
        bits = min(FILTER_BITS, max(10, int(n * BITS_PER_WINDOW).bit_length()))
        self.mask = np.uint64((1 << bits) - 1)
        self.bits = np.zeros(1 << (bits - 3), np.uint8)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return hashes & self.mask, (hashes >> np.uint64(32)) & self.mask

    def add(self, hashes: np.ndarray) -> None:
        for place in self._places(hashes):
            np.bitwise_or.at(self.bits, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for place in self._places(hashes):
            out &= (self.bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def window_filter(windows: DataFrame) -> tuple[WindowFilter, list[int]]:
    """The filter of all item windows and their sizes. The hashes pass through the driver in small parts; only the bits stay."""
    state = windows.agg(F.count("*").alias("n"), F.collect_set("size").alias("sizes")).first()  # sizes: at most WINDOW
    found = WindowFilter(state["n"])
    part: list[int] = []
    for r in windows.select("hash").distinct().toLocalIterator():
        part.append(r["hash"])
        if len(part) == 1 << 16:
            found.add(np.array(part, np.int64).view(np.uint64))
            part = []
    found.add(np.array(part, np.int64).view(np.uint64))
    return found, sorted(state["sizes"])


HIT = "array<struct<at:int,size:int,hash:long,values:array<long>,types:array<tinyint>>>"
KEY = ["k1", "k2"]  # of a text: whether it holds a passage depends on nothing else


def text_key(text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(i), text).alias(k) for i, k in enumerate(KEY)]


def window_hits(docs: DataFrame, known: WindowFilter, sizes: list[int]) -> DataFrame:
    """``(k1, k2, hits)``: the windows of each text that may be an item's; only texts with some, copies once."""
    schema = typed(f"k1 long, k2 long, hits {HIT}")

    def hits_of(t: Templates) -> tuple[np.ndarray, pa.Array]:
        at, size, hashes = [], [], []
        for k in sizes:
            a, h, _ = t.windows(k)
            hit = known.may_hold(h)
            at.append(a[hit])
            hashes.append(h[hit])
            size.append(np.full(int(hit.sum()), k))
        at, size, hashes = np.concatenate(at), np.concatenate(size), np.concatenate(hashes)
        order = np.argsort(at, kind="stable")
        at, size, hashes = at[order], size[order], hashes[order]
        text = np.searchsorted(t.first, at, "right") - 1
        ends = np.concatenate([[0], np.cumsum(size)])
        tokens = np.repeat(at - ends[:-1], size) + np.arange(ends[-1])
        offsets = pa.array(ends, pa.int32())
        structs = pa.StructArray.from_arrays(
            [
                pa.array(at - t.first[text], pa.int32()),
                pa.array(size, pa.int32()),
                pa.array(to_int64(hashes), pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(to_int64(t.value[tokens]), pa.int64())),
                pa.ListArray.from_arrays(offsets, pa.array(t.type[tokens], pa.int8())),
            ],
            names=["at", "size", "hash", "values", "types"],
        )
        held, first = np.unique(text, return_index=True)
        return held, pa.ListArray.from_arrays(pa.array(np.append(first, len(text)), pa.int32()), structs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _unit_hashes()
        for batch in batches:
            for lo, _, buf, offsets in text_chunks(batch.column(2)):
                held, found = hits_of(Templates(buf, offsets, units))
                if len(held):
                    rows = pa.array(held + lo)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), found], names=schema.fieldNames())

    text = F.col("text").cast("string")
    rows = docs.filter(text.isNotNull()).select(*text_key(text), text.alias("text")).mapInArrow(run, schema)
    return materialize(rows.groupBy(*KEY).agg(F.first("hits").alias("hits")), docs.sparkSession, "window_hits")


RUN_SCHEMA = "k1 long, k2 long, class long, start_token long, n_tokens long, n_slots long, n_changed long, n_exact long"
RUN_COLUMNS = ["start_token", "n_tokens", "n_slots", "n_changed", "n_exact"]


def _best_run(rows: list[dict]) -> tuple[int, ...] | None:
    """The longest consistent run of one text and one class (the first of equal ones); rows by size, shift and place."""
    item_values, item_types = np.array(rows[0]["item_values"]), np.array(rows[0]["item_types"])
    best, begin = None, 0
    for k in range(1, len(rows) + 1):
        last = rows[k - 1]
        if k < len(rows) and all(rows[k][c] == last[c] for c in ("size", "shift")) and rows[k]["at"] <= last["at"] + last["size"]:
            continue
        run, size, shift = rows[begin:k], last["size"], last["shift"]
        start, end, begin = run[0]["at"], last["at"] + last["size"], k
        values, types, exact = np.zeros(end - start, np.int64), np.zeros(end - start, np.int8), np.zeros(end - start, bool)
        for r in run:
            inside = slice(r["at"] - start, r["at"] - start + size)
            values[inside], types[inside] = r["values"], r["types"]
            exact[inside] |= r["exact"]
        item = slice(start - shift, end - shift)
        for lo, n, slots, changed in _consistent(values, types, item_values[item], item_types[item], size):
            if best is None or n > best[1]:
                best = (start + lo, n, slots, changed, int(exact[lo : lo + n].sum()))
    return best


def runs(hits: DataFrame, windows: DataFrame, templates: DataFrame) -> DataFrame:
    """The best run of each text of :func:`window_hits` and class."""
    schema = typed(RUN_SCHEMA)
    first = F.struct(F.col("item_id").isNull(), "item_id", "values", "types")
    chosen = templates.groupBy("class").agg(F.min_by(F.struct("values", "types"), first).alias("t"))
    chosen = chosen.select("class", F.col("t.values").alias("item_values"), F.col("t.types").alias("item_types"))
    found = hits.select(*KEY, F.inline("hits")).join(windows, ["hash", "size"])
    found = found.groupBy(*KEY, "class", "size", (F.col("at") - F.col("item_at")).alias("shift"), "at")
    found = found.agg(F.first("values").alias("values"), F.first("types").alias("types"), F.max("exact").alias("exact"))
    group = [*KEY, "class"]
    found = found.join(chosen, "class").repartition(*group).sortWithinPartitions(*group, "size", "shift", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for lo in range(0, batch.num_rows, 1000) for r in batch.slice(lo, 1000).to_pylist())
        out = []
        for key, part in groupby(rows, lambda r: tuple(r[c] for c in group)):
            if best := _best_run(list(part)):  # as many rows as the text has windows of the class
                out.append((*key, *best))
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=schema.fieldNames())
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=schema.fieldNames())

    return found.mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """The runs of all texts, written once, and the item templates; None without items."""
    templates = item_templates(benchmark)
    windows = item_windows(templates)
    known, sizes = window_filter(windows)
    if not sizes:
        return None
    hits = window_hits(docs, known, sizes)
    return materialize(runs(hits, windows, templates), docs.sparkSession, "template_runs"), templates


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and template class that it holds a passage of (the longest run).

    ``doc_id``, ``item_id`` (the smallest of the class, :func:`members` has
    all), ``start_token``, ``n_tokens``, ``n_slots``, ``n_changed`` (slots that
    differ from that item's) and ``n_exact`` (tokens inside windows that are
    equal to those of some item of the class)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *text_key(F.col("text").cast("string")))
    found = contaminated(docs, benchmark)
    if found is None:
        return rows.limit(0).select("doc_id", *[F.lit(0).cast("long").alias(c) for c in ("item_id", *RUN_COLUMNS)])
    best, templates = found
    least = templates.groupBy("class").agg(F.min("item_id").alias("item_id"))
    return rows.join(best.join(least, "class"), KEY).select("doc_id", "item_id", *RUN_COLUMNS)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, columns unchanged."""
    found = contaminated(docs, benchmark)
    if found is None:
        return docs
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *text_key(F.col("text").cast("string")))
    return rows.join(found[0].select(*KEY).distinct(), KEY, "left_anti").select("__row.*")


def benchmark_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")
