"""Secret scan with a trigram inverted index, in DataFrame functions only.

A rule's regex is parsed, and a Boolean query of trigrams that every match
must contain is derived from it: all of several clauses (one for each
mandatory run of the regex), each any of some alternatives, each all of a set
of trigrams. The
inverted index holds, for each trigram that some query names, the documents
in whose lower-cased text it occurs (one posting row each, written once).
A query is answered by intersecting postings: posting rows are joined with
the alternatives that name their trigram (a fixed, small table) and counted
per document and alternative; a document that completes an alternative of
every clause is a candidate of the rule. Candidates are verified with the regex itself. Rules without
mandatory trigrams scan all documents.

Documents are keyed by id and a hash of their text, so postings of rows that
repeat both are the same postings. Null texts are empty: no spans. Null ids
are a key like any other. No group is collected: postings are counted, and
a document has at most as many as the queries have trigrams.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.quality import bind
from mercato.session import materialize

MAX_LITERALS = 64  # alternatives followed while deriving a query


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str  # read alike by Java and Python
    min_chars: int = 1  # of the group
    group: int = 0


# fixed values: the base kinds in their order, then known credential formats
RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]{32,}", 32),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}"),
    Rule("url_password", r"[a-z]+://[A-Za-z0-9._-]+:[^\x20\x09-\x0D:/@]{4,}@"),
]
BASE_KINDS = ["assign", "access", "hex"]

Clause = frozenset[frozenset[str]]  # any of the sets; all trigrams of a set
Query = set[Clause]  # all clauses


def trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def trigram_query(pattern: str) -> Query | None:
    """Trigrams (lower case) that every match contains; None if there are none to rely on."""
    parser = re._parser
    found: Query = set()

    def literals(node) -> set[str] | None:
        """All texts a node can match, if they are few."""
        op, arg = str(node[0]), node[1]
        if op == "LITERAL":
            return {chr(arg).lower()}
        if op == "IN":
            out = set()
            for kind, value in arg:
                if str(kind) == "LITERAL":
                    out.add(chr(value).lower())
                elif str(kind) == "RANGE" and value[1] - value[0] < 4:
                    out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
                else:
                    return None
            return out if len(out) <= 8 else None
        if op == "SUBPATTERN":
            return sequence(arg[-1])
        if op == "BRANCH":
            parts = [sequence(branch) for branch in arg[1]]
            return None if any(p is None for p in parts) else set().union(*parts)
        if op == "MAX_REPEAT" and int(arg[1]) <= 5:
            one = sequence(arg[2])
            out: set[str] = set()
            for n in range(int(arg[0]), int(arg[1]) + 1):
                if one is None or (len(one) or 1) ** n > MAX_LITERALS:
                    return None
                out |= {"".join(p) for p in product(one, repeat=n)}
            return out
        return None

    def sequence(nodes) -> set[str] | None:
        out = {""}
        for node in nodes:
            some = literals(node)
            if some is None or len(out) * len(some) > MAX_LITERALS:
                return None
            out = {a + b for a in out for b in some}
        return out

    def close(run: set[str]) -> None:
        if all(len(s) >= 3 for s in run):
            sets = {trigrams(s) for s in run}
            found.add(frozenset(s for s in sets if not any(t < s for t in sets)))

    def walk(nodes) -> None:
        run = {""}
        for node in nodes:
            some = literals(node)
            if some is not None and len(run) * len(some) <= MAX_LITERALS:
                run = {a + b for a in run for b in some}
                continue
            close(run)
            run = {""}
            if some is not None:
                run = some
            elif str(node[0]) == "SUBPATTERN":
                walk(node[1][-1])
        close(run)

    walk(list(parser.parse(pattern)))
    return found or None  # all runs are mandatory


QUERIES = {r.kind: q for r in RULES if (q := trigram_query(r.pattern))}
GRAMS = sorted({g for q in QUERIES.values() for clause in q for s in clause for g in s})


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def postings(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The inverted index: ``(gram, doc_id, text_key)`` for the trigrams of the queries."""
    rows = _keyed(docs).withColumn("low", F.lower("text"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(GRAMS)]))
    return materialize(rows.select("doc_id", "text_key", F.explode(present).alias("gram")), spark, "postings")


def candidates(spark: SparkSession, index: DataFrame) -> DataFrame:
    """``(doc_id, text_key, rules)``: the indexed rules whose query the document satisfies."""
    number = {g: i for i, g in enumerate(GRAMS)}
    table = [
        (kind, clause, len(query), alternative, len(grams), number[g])
        for kind, query in QUERIES.items()
        for clause, sets in enumerate(sorted(sorted(map(sorted, c)) for c in query))
        for alternative, grams in enumerate(sets)
        for g in grams
    ]
    queries = spark.createDataFrame(table, "kind string, clause int, clauses int, alternative int, need int, gram int")
    met = (
        index.join(F.broadcast(queries), "gram")  # as large as the rule set
        .groupBy("doc_id", "text_key", "kind", "clause", "clauses", "alternative", "need")
        .agg(F.size(F.collect_set("gram")).alias("n"))
        .filter("n = need")
        .groupBy("doc_id", "text_key", "kind", "clauses")
        .agg(F.size(F.collect_set("clause")).alias("n"))
        .filter("n = clauses")
    )
    return met.groupBy("doc_id", "text_key").agg(F.collect_set("kind").alias("rules"))


OPEN, CLOSE, OTHER = "\ue000", "\ue001", "\ue002"
SPAN = "array<struct<s:int,o:int,e:int,k:string>>"


def spans(text: Column, rule: Rule) -> Column:
    """The rule's matches, leftmost and not overlapping, as (start, order, end, kind) in code points.

    Matches are wrapped in two private characters (such characters in the
    text are replaced first), the text is split there, and the lengths of
    the parts give the places."""
    order = [r.kind for r in RULES].index(rule.kind)
    marked = F.regexp_replace(F.translate(text, OPEN + CLOSE, OTHER * 2), rule.pattern, f"{OPEN}$0{CLOSE}")

    def read(parts: Column) -> Column:
        def step(acc: Column, part: Column) -> Column:
            end = acc["at"] + F.char_length(part)
            span = F.struct(acc["at"].alias("s"), F.lit(order).alias("o"), end.alias("e"), F.lit(rule.kind).alias("k"))
            size = F.char_length(F.regexp_extract(part, rule.pattern, rule.group))
            found = acc["inside"] & (size >= rule.min_chars)
            return F.struct(
                end.alias("at"),
                (~acc["inside"]).alias("inside"),
                F.when(found, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"),
            )

        start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("inside"), F.array().cast(SPAN).alias("out"))
        return F.aggregate(parts, start, step, lambda acc: acc["out"])

    return F.when(F.rlike(text, F.lit(rule.pattern)), bind(F.split(marked, f"[{OPEN}{CLOSE}]", -1), read))


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["k"], x["s"], x["e"])), ",")


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row."""
    hits = candidates(spark, postings(spark, docs)).withColumnsRenamed({"doc_id": "__id", "text_key": "__key"})
    rows = _keyed(docs)
    rows = rows.join(hits, rows["doc_id"].eqNullSafe(hits["__id"]) & (rows["text_key"] == hits["__key"]), "left")
    none, text = F.array().cast(SPAN), F.col("text")
    parts = []
    for rule in RULES:
        found = spans(text, rule)
        if rule.kind in QUERIES:
            found = F.when(F.array_contains("rules", rule.kind), found)
        parts.append(F.coalesce(found, none).alias(f"f_{rule.kind}"))
    rows = rows.select("doc_id", *parts)
    base = F.sort_array(F.concat(*[F.col(f"f_{k}") for k in BASE_KINDS]))
    every = F.sort_array(F.concat(*[F.col(f"f_{r.kind}") for r in RULES]))
    return rows.select(
        "doc_id",
        *[F.size(f"f_{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
    )
