"""Toxicity by a weighted finite-state pattern grammar.

Five word classes are told apart: insult, threat, target, negation and
reported speech. Targets, negations, reports and threats are fixed words;
insult arcs are learnt, as whole words and as stems (a word's first bytes),
and carry their log-odds as weight (threats: the median of the insults'). Four small transducers read the classes
of a clause: one remembers whether someone is addressed, one whether a
negation is near, one whether speech is reported, one turns a threat into
weight only if it meets a target, before or after it. Those for insults and
those for threats are composed into a machine each; the state it ends in
gives the arc a context, and a clause weighs the sum of its arcs' weights
times their contexts' weights (``CONTEXTS``). So the same word weighs
differently in "you idiot", "an idiot", "not an idiot" and "he called it
trash", and "I will not hurt you" is hardly a threat. A logistic regression
scores a document by the weights of its clauses: all, the heaviest, and how
many arcs matched.

Learning uses at most ``SAMPLE`` labelled rows (those with the smallest
hashes of their ids), none of them held out: a row is held out where
crc32(id as text) mod 3 is 1. Of near copies among them (three 1-minhashes)
the smallest id counts, or every word of a copied toxic text would look like
an insult.
The regression is fitted on weights that the other half of the sample gave
(two folds). All rows are scored, on whole texts; the score sees the text
only. Very long texts are read whole, about a megabyte of text at a time
(a longer text alone).

Null and empty texts match nothing and get the score of no match. Without
usable labels every score is 0. An empty table gives an empty result. Other
columns, whatever their names, are not read. Repeated labels of an id count
as toxic if one says so; repeated rows get equal scores.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.frames import typed
from mercato.llm.words import _BYTE_POWERS, _BYTES, prefix_sums, range_hash, text_chunks
from mercato.session import materialize

SAMPLE = 12_000
THRESHOLD = 0.7
MIN_SUPPORT, MIN_Z = 3, 2.7
STEMS = (4, 5)  # bytes
STEM_FROM = 7  # bytes of the shortest word that a stem may match
REACH = 6  # words after which a negation or target is forgotten

INSULT, THREAT, TARGET, NEGATION, REPORT = range(1, 6)
# fixed values: function words of the classes, in the four languages
LEXICON = {
    THREAT: "kill hurt destroy attack shoot murder strangle burn töten umbringen schlagen vernichten tuer frapper détruire matar golpear destruir",
    TARGET: "you your yours u he him his she her they them their these those this du dich dir dein ihr euch sie er tu te toi ton vous votre il elle ils elles tú ti usted ustedes él ella ellos",
    NEGATION: "not no never nor isn't aren't wasn't don't doesn't nicht kein keine nie niemals ne pas jamais aucun nunca jamás ningún",
    REPORT: "said says say called calls quoted quote claimed claims wrote told reported according sagte sagt nannte schrieb dit appelé écrit selon dijo llamó escribió según",
}

_TOKEN = np.zeros(256, bool)
_TOKEN[48:58] = _TOKEN[97:123] = _TOKEN[65:91] = True
_TOKEN[128:] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?;:\n\r")] = True


class Transducer:
    """Deterministic transducer over word classes: ``step[state][symbol] = (state, flag)``; state 0 starts."""

    def __init__(self, step: list[dict[int, tuple[int, bool]]]):
        self.step = step

    def read(self, state: int, symbol: int) -> tuple[int, bool]:
        return self.step[state].get(symbol, (state, False))


def _memory(trigger: int, at: tuple[int, ...] = (INSULT, THREAT)) -> Transducer:
    """Flags the classes ``at`` that come after a ``trigger`` word of the clause."""
    return Transducer([{trigger: (1, False)}, {k: (1, True) for k in at}])


def _meeting() -> Transducer:
    """Flags a threat after a target, and a target after a threat that met none before."""
    return Transducer([{TARGET: (1, False), THREAT: (2, False)}, {THREAT: (1, True)}, {TARGET: (1, True)}])


SILENT = Transducer([{}])
PARTS = {"target": _memory(TARGET), "negated": _memory(NEGATION), "reported": _memory(REPORT)}
#: threats are written at the threat or the later target, so negation and report are flagged at both
THREATS = {"threat": _meeting(), "negated": _memory(NEGATION, (THREAT, TARGET)), "reported": _memory(REPORT, (THREAT, TARGET))}


def compose(parts: dict[str, Transducer]) -> tuple[list[list[int]], list[list[int]]]:
    """The product machine: next state and written flags (a bit per part) for each state and class."""
    states = list(product(*[range(len(p.step)) for p in parts.values()]))
    number = {s: i for i, s in enumerate(states)}
    nxt, flags = [], []
    for s in states:
        row, out = [], []
        for symbol in range(6):
            read = [p.read(x, symbol) for p, x in zip(parts.values(), s, strict=True)]
            row.append(number[tuple(r[0] for r in read)])
            out.append(sum(r[1] << i for i, r in enumerate(read)))
        nxt.append(row)
        flags.append(out)
    return nxt, flags


def _hash(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b" ".join(words), np.uint8)
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    return range_hash(prefix_sums(_BYTES[data], _BYTE_POWERS), ends - sizes, ends, _BYTE_POWERS)


class Tokens:
    """Tokens (letters, digits and all non-ASCII bytes) of lower-case texts."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        token, n = _TOKEN[buf], len(buf)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        follows, leads = np.zeros(n, bool), np.zeros(n, bool)
        follows[1:], leads[:-1] = token[:-1], token[1:]
        self.start = np.flatnonzero(token & ~(follows & ~edge[:-1]))
        self.end = np.flatnonzero(token & ~(leads & ~edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.sums = prefix_sums(_BYTES[buf], _BYTE_POWERS)
        self.hash = range_hash(self.sums, self.start, self.end, _BYTE_POWERS)
        self.owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        stops = np.concatenate([[0], np.cumsum(_STOP[buf])])[self.start]
        new = np.ones(len(self.start), bool)
        new[1:] = (stops[1:] != stops[:-1]) | (self.owner[1:] != self.owner[:-1])
        self.clause = np.cumsum(new)

    def stem(self, size: int) -> np.ndarray:
        """Hashes of the tokens' first bytes; 0 for tokens too short for a stem."""
        fits = self.end - self.start >= STEM_FROM
        out = np.zeros(len(self.start), np.uint64)
        out[fits] = range_hash(self.sums, self.start[fits], self.start[fits] + size, _BYTE_POWERS)
        return out


#: a context's weight; ``threat``: a target stands before the threat, ``threat_ahead``: after it
CONTEXTS = {"plain": 1.0, "target": 1.25, "negated": 0.25, "reported": 0.25, "threat": 1.25, "threat_ahead": 1.25}
PLAIN, ADDRESSED, NEGATED, REPORTED, MENACE, MENACE_AHEAD = range(len(CONTEXTS))
READOUT = [*CONTEXTS, "heaviest", "matches"]
HEAVIEST, MATCHES = len(CONTEXTS), len(CONTEXTS) + 1
CONTEXT_WEIGHT = list(CONTEXTS.values())


class Grammar:
    """The insult arcs and the composed machines; parts named in ``without`` stay silent."""

    def __init__(self, insults: dict[bytes, float], without: Collection[str] = ()):
        words = {w: v for w, v in insults.items() if not w.endswith(b"*")}
        threat = float(np.median(list(insults.values()))) if insults else 1.0
        self.words = self._table([(w, INSULT, v) for w, v in words.items()] + [(w.encode(), c, threat) for c, ws in LEXICON.items() for w in ws.split() if w.encode() not in words])
        self.stems = {n: self._table([(w[:-1], INSULT, v) for w, v in insults.items() if w.endswith(b"*") and len(w) == n + 1]) for n in STEMS}
        self.next, self.flags = compose({k: SILENT if k in without else p for k, p in PARTS.items()})
        self.threat_next, self.threat_flags = compose({k: SILENT if k in without else p for k, p in THREATS.items()})

    @staticmethod
    def _table(arcs: list[tuple[bytes, int, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not arcs:
            return np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0)
        h = _hash([a[0] for a in arcs])
        order = np.argsort(h)
        return h[order], np.array([a[1] for a in arcs], np.int8)[order], np.array([a[2] for a in arcs])[order]

    @staticmethod
    def _look(table, hashes: np.ndarray) -> np.ndarray:
        if not len(table[0]):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(table[0], hashes), len(table[0]) - 1)
        return np.where(table[0][at] == hashes, at, -1)

    def readout(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row of ``READOUT`` per text: arc weights by context, the heaviest clause, matched arcs."""
        t = Tokens(buf, offsets)
        out = np.zeros((len(offsets) - 1, len(READOUT)))
        if not len(t.start):
            return out
        kind, weight = np.zeros(len(t.start), np.int8), np.zeros(len(t.start))
        for table, hashes in [*((self.stems[n], t.stem(n)) for n in STEMS), (self.words, t.hash)]:  # whole words last: they win
            at = self._look(table, hashes)
            hit = at >= 0
            kind[hit], weight[hit] = table[1][at[hit]], table[2][at[hit]]
        matched = np.unique(t.clause[(kind == INSULT) | (kind == THREAT)])
        if not len(matched):
            return out
        read = np.flatnonzero((kind > 0) & np.isin(t.clause, matched))
        # a target may also follow: the clause is read forward and the arcs that wait for one are moved then
        state, threat, clause, place, text, total, owed, due = 0, 0, -1, 0, -1, 0.0, [], []
        for i, c, k, w, d in zip(read.tolist(), t.clause[read].tolist(), kind[read].tolist(), weight[read].tolist(), t.owner[read].tolist(), strict=True):
            if c != clause:
                if text >= 0:
                    out[text, HEAVIEST] = max(out[text, HEAVIEST], total)
                state, threat, clause, total, owed, due = 0, 0, c, 0.0, [], []
            elif i - place > REACH:
                state = threat = 0
            text, place, row = d, i, out[d]
            flags, state = self.flags[state][k], self.next[state][k]
            menace, threat = self.threat_flags[threat][k], self.threat_next[threat][k]
            if k == INSULT:
                context = NEGATED if flags & 2 else REPORTED if flags & 4 else ADDRESSED if flags & 1 else PLAIN
                row[context] += w
                row[MATCHES] += 1
                total += w * CONTEXT_WEIGHT[context]
                if not flags:
                    owed.append((i, w))
            elif k == THREAT and not menace & 1:
                due.append((i, w))
            elif (k == THREAT or k == TARGET) and menace & 1:
                met = [w] if k == THREAT else [v for j, v in due if i - j <= REACH]
                context = NEGATED if menace & 2 else REPORTED if menace & 4 else MENACE if k == THREAT else MENACE_AHEAD
                row[context] += sum(met)
                row[MATCHES] += len(met)
                total += sum(met) * CONTEXT_WEIGHT[context]
            if k == TARGET:
                due = []
                if self.flags[state][INSULT] & 1:  # an insult here would be flagged: the target part is not silent
                    for j, v in owed:
                        if i - j <= REACH:
                            row[PLAIN] -= v
                            row[ADDRESSED] += v
                            total += v * (CONTEXT_WEIGHT[ADDRESSED] - CONTEXT_WEIGHT[PLAIN])
                owed = []
        out[text, HEAVIEST] = max(out[text, HEAVIEST], total)
        return out

    def features(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """All clauses' weight, the heaviest clause's and the matches of each text, as logarithms."""
        read = self.readout(buf, offsets)
        weights = read[:, : len(CONTEXTS)] @ np.array(CONTEXT_WEIGHT)
        return np.log1p(np.maximum(np.column_stack([weights, read[:, HEAVIEST], read[:, MATCHES]]), 0))


class Model:
    def __init__(self, grammar: Grammar, weights: np.ndarray):
        self.grammar, self.weights = grammar, weights

    def score(self, features: np.ndarray) -> np.ndarray:
        z = self.weights[0] + features @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 30) -> np.ndarray:
    """Newton's method with a ridge on all weights but the first."""
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.r_[1e-3, np.full(x.shape[1] - 1, ridge)]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (y - p) - penalty * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        w = w + np.linalg.solve(h, g)
    return w


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(spark: SparkSession, docs: DataFrame, labels: DataFrame, n: int = SAMPLE) -> DataFrame:
    """At most ``n`` labelled rows ``(text, toxic, fold)``, near copies once."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    ids = ids.filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text"))
    rows = rows.join(F.broadcast(ids), "doc_id").filter(F.col("text").isNotNull())  # n ids
    words = F.split("text", r"\s+")
    rows = rows.withColumn("words", words)
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - 4))
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(F.col("words"), i, 5)))
    rows = rows.withColumn("hashes", hashes).withColumns(
        {f"m{k}": F.array_min(F.transform("hashes", lambda h, k=k: F.xxhash64(h, F.lit(k)))) for k in range(3)}
    )
    kept = ["doc_id", "text", "toxic", "m0", "m1", "m2"]
    for k in range(3):
        first = F.min_by(F.struct(*kept), F.struct("doc_id", F.xxhash64("text")))
        rows = rows.groupBy(F.col(f"m{k}").alias("same")).agg(first.alias("row")).select("row.*")
    fold = F.pmod(F.xxhash64("m0"), F.lit(2)).cast("int")
    return materialize(rows.select("text", "toxic", fold.alias("fold")), spark, "toxicity_sample")


def arc_counts(rows: DataFrame) -> DataFrame:
    """Documents per arc (a token, or a stem with a star), label and fold."""
    schema = typed("arc binary, toxic int, fold int, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, fold = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for lo, hi, buf, offsets in text_chunks(batch.column(0)):
                t, data, found = Tokens(buf, offsets), buf.tobytes(), Counter()
                for i in range(hi - lo):
                    a, b = int(t.first[i]), int(t.first[i + 1])
                    arcs = {data[s:e] for s, e in zip(t.start[a:b].tolist(), t.end[a:b].tolist(), strict=True)}
                    arcs |= {w[:k] + b"*" for w in arcs if len(w) >= STEM_FROM for k in STEMS}
                    found.update((w, toxic[lo + i], fold[lo + i]) for w in arcs)
                keys = list(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.int32()), pa.array([found[k] for k in keys], pa.int64())],
                    names=schema.fieldNames(),
                )

    return rows.select("text", "toxic", "fold").mapInArrow(run, schema)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, n: int = SAMPLE, without: Collection[str] = ()) -> Model | None:
    """The grammar and the regression; parts named in ``without`` are left out (for comparisons)."""
    rows = sample(spark, docs, labels, n)
    sizes = {(r["fold"], r["toxic"]): r["count"] for r in rows.groupBy("fold", "toxic").count().collect()}  # four rows
    if not any(k[1] for k in sizes):
        return None
    side = {f"{'pn'[1 - y]}{f}": F.sum(F.when((F.col("toxic") == y) & (F.col("fold") == f), F.col("n")).otherwise(0)) for y in (0, 1) for f in (0, 1)}
    counts = arc_counts(rows).groupBy("arc").agg(*[e.alias(c) for c, e in side.items()])
    counts = counts.filter(F.col("p0") + F.col("p1") >= MIN_SUPPORT).filter((F.col("p0") + F.col("p1")) * 3 > F.col("n0") + F.col("n1"))
    arcs = [(bytes(r["arc"]), np.array([[r["p0"], r["p1"]], [r["n0"], r["n1"]]], float)) for r in counts.collect()]  # bounded by the sample

    fixed = {w.encode() for words in LEXICON.values() for w in words.split()}  # these have their class

    def insults(folds: list[int]) -> dict[bytes, float]:
        toxic, clean = (sum(sizes.get((f, y), 0) for f in folds) for y in (1, 0))
        out = {}
        for arc, c in arcs:
            if arc in fixed:
                continue
            p, q = c[0, folds].sum(), c[1, folds].sum()
            w = np.log((p + 0.5) / (toxic + 1)) - np.log((q + 0.5) / (clean + 1))
            if p >= MIN_SUPPORT and w >= MIN_Z * np.sqrt(1 / (p + 0.5) + 1 / (q + 0.5)):
                out[arc] = float(w)
        return out

    grammars = [Grammar(insults([1 - f]), without) for f in (0, 1)]  # rows of a fold are read with the other's arcs
    schema = typed("toxic int, x array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = np.array(batch.column(2).to_pylist())
            for lo, hi, buf, offsets in text_chunks(batch.column(0)):
                both = np.stack([g.features(buf, offsets) for g in grammars])
                x = both[fold[lo:hi], np.arange(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(lo, hi - lo), pa.array(list(x), pa.list_(pa.float64()))], names=["toxic", "x"])

    table = rows.select("text", "toxic", "fold").mapInArrow(run, schema).collect()  # at most n rows of numbers
    x, y = np.array([r["x"] for r in table]), np.array([r["toxic"] for r in table], float)
    order = np.lexsort((*x.T, y))  # the order of collected rows must not matter
    return Model(Grammar(insults([0, 1]), without), fit_logistic(x[order], y[order]))


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, n: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = train(spark, docs, labels, n)
    schema = typed("doc_id long, held_out boolean, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in text_chunks(batch.column(2)):
                s = np.zeros(hi - lo) if model is None else model.score(model.grammar.features(buf, offsets))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(s)], names=schema.fieldNames())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.lower(F.col("text").cast("string")).alias("text"))
    scored = rows.mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
